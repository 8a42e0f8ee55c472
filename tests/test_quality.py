import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakemart.operators import profile, quality


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "Alice", 25, 50000), (2, "Bob", 30, 60000), (3, None, 35, 70000), (4, "David", 40, 80000), (5, "Eve", 45, 90000)]
    return spark.createDataFrame(rows, "id int, name string, age int, salary int")


def test_unknown_table_with_unique_key_reports_nothing(people):
    assert quality.run_all_checks(people, "SampleTable", ["id"]).count() == 0


def _row(df, name):
    return {r["check_name"]: r for r in df.collect()}.get(name)


def test_severities(spark):
    rows = [("1", "P1", 1, None if i < 6 else "x", "2011-01-01", 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Quantity int, Country string, InvoiceDate string, UnitPrice double")
    got = quality.evaluate(df, "T", quality.completeness_rules(df, "T", {"T": ["Country", "Quantity"]}))
    assert _row(got, "Completeness_Country")["severity"] == "critical"
    assert _row(got, "Completeness_Country")["failure_rate"] == pytest.approx(0.06)
    assert _row(got, "Completeness_Quantity")["severity"] == "low"
    bad = df.withColumn("Quantity", F.when(F.rand(1) < 2, 0))
    assert _row(quality.evaluate(bad, "T", quality.accuracy_rules(bad)), "Accuracy_Quantity_Range")["severity"] == "high"
    assert quality.evaluate(df, "T", quality.validity_rules(df)).count() == 0
    odd = df.withColumn("StockCode", F.lit(None).cast("string"))
    assert _row(quality.evaluate(odd, "T", quality.validity_rules(odd)), "Validity_StockCode_Format")["severity"] == "high"
    assert _row(quality.uniqueness(df, "T", ["InvoiceNo"]), "Uniqueness_InvoiceNo")["records_failed"] == 99


def test_gate_and_score(spark):
    def log(*rows):
        return spark.createDataFrame(
            [("c", "t", "completeness", s, n, f, f / n, "m") for s, n, f in rows],
            "check_name string, table_name string, check_type string, severity string, records_checked bigint, "
            "records_failed bigint, failure_rate double, error_message string")

    assert quality.load_gate(log(("low", 100, 50))).first()["proceed"]
    assert quality.load_gate(log(("critical", 100, 5))).first()["proceed"]
    closed = log(("critical", 100, 6))
    assert not quality.load_gate(closed).first()["proceed"]
    with pytest.raises(ValueError):
        quality.require_quality(closed)
    assert quality.quality_score(log(("critical", 10, 1), ("low", 10, 0))).first()[0] == pytest.approx(0.75)
    assert quality.quality_score(log(("critical", 10, 1), ("low", 10, 0)), failed_only=True).first()[0] == pytest.approx(0.8)
    assert quality.quality_score(log(*[("critical", 10, 1)] * 6)).first()[0] == 0.0


def test_frame_metrics(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "x int, y string")
    got = quality.frame_metrics(df).first()
    assert (got["total_rows"], got["missing_values"], got["duplicate_rows"]) == (4, 2, 1)
    assert got["missing_percentage"] == 25.0 and got["completeness_score"] == 50.0


def test_profile_against_pandas(spark):
    rng = np.random.default_rng(5)
    values = np.round(rng.normal(10, 40, 400), 2)
    pdf = pd.DataFrame({"v": values, "n": rng.integers(-3, 4, 400)})
    df = spark.createDataFrame(pdf).selectExpr("CAST(v AS decimal(10,2)) AS v", "CAST(n AS int) AS n")
    got = {r["column_name"]: r for r in profile.profile_numeric(df).collect()}
    for c in ("v", "n"):
        assert got[c]["mean_value"] == pytest.approx(pdf[c].mean())
        assert got[c]["std_value"] == pytest.approx(pdf[c].std())
        assert got[c]["median_value"] == pytest.approx(pdf[c].median())
        assert got[c]["unique_count"] == pdf[c].nunique()
        assert got[c]["zero_count"] == (pdf[c] == 0).sum() and got[c]["negative_count"] == (pdf[c] < 0).sum()
    q1, q3 = pdf["v"].quantile([0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    expected = int(((pdf["v"] < low) | (pdf["v"] > high)).sum())
    assert profile.detect_outliers(df, ["v"]).count() == expected


def test_profile_text(spark):
    df = spark.createDataFrame([("ab",), ("",), ("  ",), (None,)], "t string")
    got = profile.profile_string(df).first()
    assert (got["min_length"], got["max_length"], got["empty_string_count"], got["whitespace_count"]) == (0, 3, 1, 2)
    assert got["null_count"] == 1 and got["unique_count"] == 3


def test_merged_sketches_against_all_values(spark):
    from lakemart.operators import sketches

    when = F.expr("timestamp_ntz'2011-01-03 10:00:00' + make_dt_interval(int(id % 300)) ")
    lines = spark.range(60_000, numPartitions=7).select(
        when.alias("InvoiceDate"), F.when(F.col("id") % 10 > 0, (F.col("id") * 7919 % 40_009 - 100).cast("int")).alias("q"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("c"), F.col("id") % 5000)).alias("who"), F.lit(None).cast("int").alias("none"))
    months = sketches.month_sketches(lines, ("q", "who", "none"))
    assert months.count() == 10 * 3
    parts = [sketches.merge(months.where(c)) for c in ("SaleMonth < 4", "SaleMonth >= 4")]
    assert sum(p.where("column_name = 'q'").first()["records"] for p in parts) == 60_000
    got = {r["column_name"]: r for r in sketches.merge(months).collect()}
    plain = lines.select("q", "who").toPandas()
    q = plain["q"].dropna()
    assert got["q"]["null_count"] == 6000 and got["q"]["negative_count"] == (q < 0).sum()
    assert (got["q"]["min_value"], got["q"]["max_value"]) == (q.min(), q.max())
    assert abs(got["q"]["std_value"] - q.std()) < 1e-6 and abs(got["q"]["mean_value"] - q.mean()) < 1e-9
    for name, p in (("q1_estimate", 0.25), ("median_estimate", 0.5), ("q3_estimate", 0.75)):
        assert abs((q <= got["q"][name]).mean() - p) < sketches.RANK_ERROR
    for name in ("q", "who"):
        uniques = plain[name].nunique()
        assert abs(got[name]["unique_estimate"] - uniques) <= sketches.UNIQUE_ERROR * uniques
    assert got["none"]["null_count"] == 60_000 and got["none"]["median_estimate"] is None and got["none"]["mean_value"] is None
    assert sketches.merge(sketches.month_sketches(lines.limit(0), ("q",))).count() == 0


def test_sketches_read_a_line_as_one_row(spark):
    """Groups by month and column would pass the number up to which sketches fold without a sort of all rows."""
    from lakemart.operators import sketches

    day = F.expr("timestamp_ntz'2001-01-01' + make_interval(0, cast(id % 50 as int))")
    lines = spark.range(2_000).select(day.alias("InvoiceDate"), *[(F.col("id") % n).alias(f"c{n}") for n in (2, 3, 5, 7)])
    months = sketches.month_sketches(lines, ("c2", "c3", "c5", "c7"))
    plan = months._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan[plan.index("Aggregate"):]
    got = {(r["SaleYear"], r["SaleMonth"], r["column_name"]): r for r in months.collect()}
    assert len(got) == 50 * 4
    assert {(r["records"], r["least"], r["most"]) for k, r in got.items() if k[2] == "c7"} == {(40, 0, 6)}
