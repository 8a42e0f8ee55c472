import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakemart import config, schemas
from lakemart.operators import aggregates, cleanse
from lakemart.operators.lineage import Lineage
from lakemart.plans import etl
from lakemart.plans.etl import run_etl
from lakemart.plans.warehouse import Settings
from lakemart.sinks import tables as sinks
from lakemart.sources import files
from lakemart.sources.generator import generate_lines
from lakemart.streaming import jobs


@pytest.fixture(scope="module")
def generated(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "lines")
    sinks.write_csv(generate_lines(spark, 3000), path)
    return path


def test_generator_profile(spark):
    df = generate_lines(spark, 20000)
    got = df.agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("CustomerID").isNull().cast("int")).alias("unknown"),
        F.avg(F.col("InvoiceNo").startswith("C").cast("int")).alias("cancelled"),
        F.avg((F.col("Quantity") < 0).cast("int")).alias("negative"), F.min("InvoiceDate").alias("lo"),
        F.max("InvoiceDate").alias("hi"), F.min(F.abs("Quantity")).alias("least"),
    ).first()
    assert got["n"] == 20000 and got["least"] >= 1
    assert got["unknown"] == pytest.approx(0.05, abs=0.01) and got["cancelled"] == pytest.approx(0.02, abs=0.01)
    assert got["negative"] == pytest.approx(0.069, abs=0.015)
    assert got["lo"] >= dt.datetime(2010, 12, 1) and got["hi"] < dt.datetime(2011, 12, 11)
    assert df.where("Quantity > 0 AND InvoiceNo LIKE 'C%'").count() == 0


def test_load_from_csv(spark, generated, tmp_path):
    result = run_etl(spark, generated, str(tmp_path / "w"), settings=Settings(as_of="2012-01-01"))
    assert result.status == "success" and result.rows > 1000
    star = result.star
    assert min(t.count() for t in star.tables().values()) > 0
    log = spark.read.parquet(str(tmp_path / "w" / "data_quality_log"))
    assert log.where("check_name = 'Validity_StockCode_Format'").count() == 1
    lineage = spark.read.parquet(str(tmp_path / "w" / "data_lineage")).first()
    assert lineage["SourceRecordCount"] == 3000 and lineage["TargetRecordCount"] == result.rows
    assert files.high_water_mark(star.date.withColumnRenamed("FullDate", "InvoiceDate")) <= dt.date(2011, 12, 10)


def test_incremental_load_takes_newer_lines_only(spark, generated, tmp_path):
    result = run_etl(spark, generated, str(tmp_path / "w"), settings=Settings(as_of="2012-01-01"), since="2011-06-01")
    assert result.status == "success"
    assert result.star.date.agg(F.min("FullDate")).first()[0] >= dt.date(2011, 6, 1)


def _sold(star):
    joined = star.fact.join(star.customer.select("CustomerKey", "CustomerID"), "CustomerKey").join(
        star.product.select("ProductKey", "StockCode"), "ProductKey").join(star.date.select("DateKey", "FullDate"), "DateKey")
    return sorted(map(str, joined.select("InvoiceNo", "StockCode", "CustomerID", "FullDate", "Quantity", "OrderQuantity").collect()))


def test_incremental_load_keeps_history_and_keys(spark, tmp_path, monkeypatch):
    raw = generate_lines(spark, 2000)
    root, settings = str(tmp_path / "w"), Settings(as_of="2012-01-01")
    first = etl.load(spark, raw.where("InvoiceDate < '2011-06-15'"), root, settings)
    before = {r["CustomerID"]: r["CustomerKey"] for r in first.customer.collect()}
    old_rows = first.fact.count()
    second = etl.load(spark, raw, root, Settings(as_of="2012-01-01"), since="2011-06-15")
    after = {r["CustomerID"]: r["CustomerKey"] for r in second.customer.collect()}
    assert {k: after[k] for k in before} == before and len(set(after.values())) == len(after) > len(before)
    assert second.fact.count() > old_rows
    assert second.fact.select("SalesKey").distinct().count() == second.fact.count()
    whole = etl.load(spark, raw, str(tmp_path / "x"), Settings(as_of="2012-01-01"))
    assert _sold(second) == _sold(whole)
    profile = ["CustomerID", "TotalOrders", "TotalRevenue", "CustomerSegment", "CustomerRecency"]
    assert sorted(map(str, second.customer.select(*profile).collect())) == sorted(map(str, whole.customer.select(*profile).collect()))
    # the same lines once more change nothing; a failing load leaves the star as it was
    again = etl.load(spark, raw, root, Settings(as_of="2012-01-01"), since="2011-09-01")
    assert _sold(again) == _sold(whole)
    more = raw.unionByName(generate_lines(spark, 500, seed=7))

    def fails(*_):
        raise RuntimeError("late failure")

    monkeypatch.setattr(etl.sinks, "load_summary", fails)
    with pytest.raises(RuntimeError):
        etl.load(spark, more, root, Settings(as_of="2012-01-01"), since="2011-01-01")
    assert _sold(etl.open_star(spark, root)) == _sold(whole)
    assert {r["kind"] for r in etl.loads(spark, root).collect()} == {"full", "incremental"}


def test_load_metadata_is_real(spark, tmp_path):
    a, b = Settings(), Settings()
    assert a.run_id != b.run_id
    star = etl.load(spark, generate_lines(spark, 300), str(tmp_path / "w"))
    seen = star.fact.agg(F.max("LoadTimestamp")).first()[0]
    assert abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - seen).total_seconds()) < 600
    with open(next((tmp_path / "w" / "runs").glob("*/profile_numeric/part-*"))) as rows:
        assert "median_value" in rows.read()


def test_files_are_matched_by_header_and_broken_lines_kept_aside(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
                                  "1,A,thing,2,2011-01-05 10:00:00,2.50,17,France\n")
    (folder / "b.csv").write_text("Country,StockCode,InvoiceNo,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,extra\n"
                                  "Spain,B,2,other,3,2011-01-06 10:00:00,1.50,18,x\n"
                                  "Spain,B,2\n")
    lines = files.read_lines_csv(spark, str(folder), corrupt=etl.CORRUPT)
    good = {r["InvoiceNo"]: r for r in lines.where(F.col(etl.CORRUPT).isNull()).collect()}
    assert (good["1"]["StockCode"], good["1"]["Country"]) == ("A", "France")
    assert (good["2"]["StockCode"], good["2"]["Country"]) == ("B", "Spain")
    assert [r[etl.CORRUPT] for r in lines.collect() if r[etl.CORRUPT]] == ["Spain,B,2"]
    result = run_etl(spark, str(folder), str(tmp_path / "w"))
    assert result.status == "success" and result.rows == 2
    unreadable = list((tmp_path / "w" / "runs").glob("*/unreadable_lines"))
    assert spark.read.parquet(str(unreadable[0])).count() == 1


def test_headers_of_many_files_are_one_job(spark, tmp_path):
    folder = tmp_path / "many files+"
    folder.mkdir()
    for i in range(120):
        names = ("InvoiceNo", "Country") if i % 3 else ("Country", "InvoiceNo")
        row = {"InvoiceNo": f"n{i}", "Country": "Cura\u00e7ao"}
        lines = [",".join(names)] + [",".join(row[n] for n in names)] * 300
        (folder / f"part {i}.csv").write_bytes("\n".join(lines).encode("latin-1"))
    (folder / "empty.csv").write_text("")
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    groups = files._headers(spark, str(folder), "ISO-8859-1")
    jobs = len(sc.statusTracker().getJobIdsForGroup("headers"))
    sc.setJobGroup("", "")
    assert {k: len(v) for k, v in groups.items()} == {("InvoiceNo", "Country"): 80, ("Country", "InvoiceNo"): 40}
    assert jobs <= 10
    got = files.read_lines_csv(spark, str(folder))
    assert got.count() == 120 * 300 and got.select("InvoiceNo").distinct().count() == 120
    assert [r[0] for r in got.select("Country").distinct().collect()] == ["Cura\u00e7ao"]


def test_catalog_tables_and_load_guard(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS guard")
    schemas.create_tables(spark, "guard")
    assert not sinks.already_loaded(spark, "guard.DimCustomer") and not sinks.already_loaded(spark, "guard.nothing")
    df = spark.createDataFrame([(1, "x", "FR", 5)], "CustomerKey long, CustomerID string, Country string, extra int")
    sinks.save_table(df, "guard", "DimCustomer")
    assert sinks.already_loaded(spark, "guard.DimCustomer") and "extra" not in spark.table("guard.DimCustomer").columns
    spark.sql("DROP DATABASE guard CASCADE")


def test_reports_are_only_cut_on_request(spark):
    from lakemart.operators.kpi import at_most

    assert at_most(spark.range(20_000)).count() == 20_000 and at_most(spark.range(50), 7).count() == 7


def test_missing_source_reports_failure(spark, tmp_path):
    result = run_etl(spark, str(tmp_path / "nowhere.csv"), str(tmp_path / "w"))
    assert result.status == "failed" and result.error


def test_index_column_is_dropped_and_header_checked(spark, tmp_path):
    path = str(tmp_path / "indexed")
    generate_lines(spark, 50).withColumn("index", F.lit(1)).select("index", *config.REQUIRED_COLUMNS).write.option(
        "header", True).csv(path)
    lines = files.read_lines_csv(spark, path, typed=True)
    assert lines.columns == config.REQUIRED_COLUMNS
    checks = {r["column_name"]: r for r in files.schema_check(lines).collect()}
    assert all(r["present"] and r["type_ok"] for r in checks.values())
    lost = {r["column_name"]: r["present"] for r in files.schema_check(lines.drop("Country")).collect()}
    assert not lost["Country"]


def test_schema_listing_and_conform(spark):
    listing = schemas.schema_listing(spark)
    assert listing.select("table_name").distinct().count() == 12
    df = spark.createDataFrame([(1, "x", "FR", 5)], "CustomerKey int, CustomerID string, Country string, extra int")
    assert schemas.conform(df, "DimCustomer").columns == ["CustomerKey", "CustomerID", "Country"]


def test_lineage_counts_both_sides(spark, tmp_path):
    log = Lineage(spark, "r")
    out = log.write(spark.range(100), "a", lambda df: df.where("id < 30"), "b", str(tmp_path / "t"), "Filter")
    row = log.frame().first()
    assert (row["SourceRecordCount"], row["TargetRecordCount"], out.count()) == (100, 30, 30)
    assert log.throughput().first()["RowsPerSecond"] > 0


def test_sessions_equal_a_plain_walk_with_one_busy_user(spark):
    rng, rows, at = random.Random(4), [], {}
    for i in range(3000):
        user = 1 if rng.random() < 0.6 else rng.randint(2, 20)
        at[user] = at.get(user, 0) + rng.choice([1, 30, 600, 1799, 1800, 1801, 4000])
        rows.append((i, user, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=at[user]), rng.choice(["view", "click", "purchase"])))
    df = spark.createDataFrame(rows, "event_id int, user_id int, ts timestamp_ntz, event_type string").repartition(7)
    got = {(r["user_id"], r["session_start"]): (r["events"], r["session_end"]) for r in aggregates.sessions(df).collect()}
    expected, last = {}, {}
    for _, user, ts, _ in sorted(rows, key=lambda r: (r[1], r[2])):
        if user not in last or ts - last[user][1] >= dt.timedelta(minutes=30):
            last[user] = [ts, ts, 0]
        last[user][1], last[user][2] = ts, last[user][2] + 1
        expected[(user, last[user][0])] = (last[user][2], ts)
    assert got == expected


def test_streamed_cleanse_equals_batch(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw = generate_lines(spark, 2000)
    raw.repartition(5).write.parquet(path)
    streamed = jobs.drain_append(jobs.cleansed(jobs.read_stream(spark, path, raw.schema, 2)), "test")
    batch = jobs.cleansed(spark.read.parquet(path))
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).isEmpty()
    assert batch.dropDuplicates().count() == cleanse.clean_lines(cleanse.typed_lines(raw)).count()


def test_gate_puts_bad_batches_aside(spark, tmp_path):
    from lakemart.operators import quality

    path = str(tmp_path / "raw")
    raw = generate_lines(spark, 400)
    raw.coalesce(1).write.mode("append").parquet(path)
    raw.withColumn("Country", F.lit(None).cast("string")).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.read_stream(spark, path, raw.schema, files_per_batch=1)
    out = jobs.gated_load(stream, lambda b: quality.completeness_rules(b, "T", {"T": ["Country"]}), "T")
    got = {r["outcome"]: r["count"] for r in out.groupBy("outcome").count().collect()}
    assert got == {"loaded": 400, "quarantined": 400}
    assert out.where("outcome = 'quarantined' AND Country IS NOT NULL").isEmpty()


def test_update_mode_drops_state_behind_the_watermark(spark, tmp_path):
    path = str(tmp_path / "events")
    for day in (1, 12, 23):
        spark.range(48).selectExpr(f"TIMESTAMP_NTZ '2020-01-{day:02d} 00:00:00' + make_dt_interval(0, cast(id AS int)) AS ts",
                                   "1.5D AS value").coalesce(1).write.mode("append").parquet(path)
    stream = jobs.read_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    progress: list = []
    table = jobs.drain_upsert(jobs.windowed(stream, "ts", "value"), "state", ["window_start", "window_end"], progress)
    assert table.count() == 3 * 48 and {r["events"] for r in table.collect()} == {1}
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(kept) <= 2 * 48 + 2 and kept[-1] < 48


def _plain_rows(frame):
    return sorted(map(str, frame.collect()))


def test_kept_aggregates_equal_a_rebuild_and_read_touched_months_only(spark, tmp_path):
    # every invoice lies in one month, so newer lines leave earlier months alone
    raw = generate_lines(spark, 1500).withColumn("InvoiceNo", F.concat(F.date_format("InvoiceDate", "yyyyMM"), "InvoiceNo"))
    root, settings = str(tmp_path / "w"), lambda: Settings(as_of="2012-01-01")
    etl.load(spark, raw.where("InvoiceDate < '2011-06-15'"), root, settings(), keep_aggregates=True)
    star = etl.load(spark, raw, root, settings(), since="2011-06-15")
    kept, fact = etl.open_aggregates(spark, root), star.fact
    assert _plain_rows(kept["AggDailySales"]) == _plain_rows(aggregates.daily_sales(fact))
    assert _plain_rows(kept["AggMonthlySales"]) == _plain_rows(aggregates.monthly_sales(fact))
    first, second = etl.newest_load(spark, root).parts
    assert max(first.months) < min(second.months) == 201106
    # the second load has written the months it touched and no others
    written = spark.read.parquet(f"{second.path}/agg_daily").select("SaleYear", "SaleMonth").distinct().collect()
    assert {r.SaleYear * 100 + r.SaleMonth for r in written} == set(second.months)
    # sketches follow the same months, and their merger speaks of all lines held
    sketched = spark.read.parquet(f"{second.path}/profile_months").select("SaleYear", "SaleMonth").distinct().collect()
    assert {r.SaleYear * 100 + r.SaleMonth for r in sketched} == set(second.months)
    merged = {r["column_name"]: r for r in etl.open_profile(spark, root).collect()}
    sums = fact.agg(F.count(F.lit(1)).alias("n"), F.max("Quantity").alias("most"), F.avg("Quantity").alias("mean")).first()
    assert (merged["Quantity"]["records"], merged["Quantity"]["max_value"]) == (sums["n"], sums["most"])
    assert merged["Quantity"]["mean_value"] == pytest.approx(sums["mean"])
    plain = str(tmp_path / "x")
    etl.load(spark, raw, plain, settings())
    with pytest.raises(ValueError, match="keeps no aggregates"):
        etl.open_aggregates(spark, plain)
    with pytest.raises(ValueError, match="from a full load on"):
        etl.load(spark, raw, plain, settings(), since="2011-09-01", keep_aggregates=True)


def test_two_loads_at_once_are_both_kept(spark, tmp_path, monkeypatch):
    raw, root = generate_lines(spark, 1500), str(tmp_path / "w")
    settings = lambda: Settings(as_of="2012-01-01")
    etl.load(spark, raw.where("InvoiceDate < '2011-03-01'"), root, settings())
    commit, inner = etl._commit, []

    def late(*args):
        if not inner:
            # another load starts and ends while this one is about to switch the star
            inner.append(True)
            etl.load(spark, raw.where("InvoiceDate < '2011-08-01'"), root, settings(), since="2011-03-01")
        return commit(*args)

    monkeypatch.setattr(etl, "_commit", late)
    star = etl.load(spark, raw.where("InvoiceDate >= '2011-08-01'"), root, settings(), since="2011-08-01")
    whole = etl.load(spark, raw, str(tmp_path / "x"), settings())
    assert _sold(star) == _sold(whole) == _sold(etl.open_star(spark, root))
    assert [r.load for r in etl.loads(spark, root).orderBy("load").collect()] == [0, 1, 2]
    assert star.fact.select("SalesKey").distinct().count() == star.fact.count()
    assert star.fact.select("InvoiceNo", "InvoiceKey").distinct().count() == star.fact.select("InvoiceNo").distinct().count()
    assert star.tops["InvoiceKey"] == star.fact.agg(F.max("InvoiceKey")).first()[0]


def test_only_one_of_two_writers_creates_a_file(spark, tmp_path):
    path = str(tmp_path / "loads" / "0000000001.json")
    assert sinks.create_if_absent(spark, path, "first") and not sinks.create_if_absent(spark, path, "second")
    with open(path) as held:
        assert held.read() == "first"
