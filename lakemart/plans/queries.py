"""The registered queries: name to function of (spark, folder of order tables)."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart import config
from lakemart.functions.columns import clean_text, in_range
from lakemart.functions.ranks import dense_key
from lakemart.ml import churn, dbscan, forecast, iforest, kmeans, runner
from lakemart.operators import aggregates, analytics, cleanse, dims, fact, features, kpi, lineage, profile, quality, sketches
from lakemart.plans import etl
from lakemart.plans.warehouse import DRIVER_SETTINGS, RUN_ID, open_warehouse
from lakemart.session import release, shuffle_width, work_dir
from lakemart.sinks import tables as sinks
from lakemart.sources import files, retail
from lakemart.streaming import jobs, sessions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- parameters of the checked runs, one literal per branch of each rule ---------
RFM_CUTS = {
    "recency_days": [60, 120, 200, 300],
    "frequency": [13, 10, 8, 6],
    "monetary": [1130000, 928000, 772000, 580000],
}
CLV_TIERS = [(1130000, "Premium"), (928000, "Gold"), (772000, "Silver"), (580000, "Bronze")]
PRODUCT_GRADES = [
    (800000, 30, "Star"), (680000, 26, "Cash Cow"), (600000, 24, "Question Mark"), (500000, 0, "Potential"),
]
MARKETS = [(55000000, "Major Market"), (48000000, "Important Market"), (42000000, "Growing Market")]
VALUE_STEPS = [(900000, "High Value"), (600000, "Medium Value")]
BASIC_CLASSES = [(["widget"], "Bags"), (["anvil"], "Clothing"), (["gear"], "Home"), (["plate"], "Storage")]
FILTERS = kpi.Filters(
    countries=("NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13"),
    segments=("Champions_Premium", "Loyal_High", "Potential_Low", "At Risk_Medium", "Champions_Low"),
    categories=("Bags", "Home", "Office"),
)
DATES = kpi.Filters(start="1997-03-15", end="1999-10-02")


def as_of():
    return F.lit("2001-09-01").cast("date")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for output."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    """Interpolated values to fixed places: engines differ in the last bit of an interpolation."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def star(spark: SparkSession, sf_dir: str):
    return open_warehouse(spark, sf_dir).star()


# --- sources, typing, cleansing -----------------------------------------------------
@query
def src_csv_roundtrip(spark, sf_dir):
    raw = open_warehouse(spark, sf_dir).raw
    path = work_dir(spark, f"csv_roundtrip-{uuid4().hex}")
    sinks.write_csv(raw, path)
    return plain(cleanse.typed_lines(files.read_sources(spark, path, "csv")))


@query
def incr_extract(spark, sf_dir):
    return plain(files.incremental(open_warehouse(spark, sf_dir).raw, "2000-01-01"))


@query
def ml_source_sales(spark, sf_dir):
    return plain(features.ml_sales(star(spark, sf_dir)))


@query
def schema_check(spark, sf_dir):
    checked = files.schema_check(open_warehouse(spark, sf_dir).raw)
    optional = F.col("column_name").isin("InvoiceDate", "CustomerID")
    return checked.select("column_name", "present", "data_type", "type_ok",
                          (optional | (F.col("values_in_first_rows") == 5)).alias("filled"))


@query
def meta_filter_values(spark, sf_dir):
    return kpi.filter_values(star(spark, sf_dir))


@query
def etl_typed_raw(spark, sf_dir):
    text = retail.text_lines(open_warehouse(spark, sf_dir).raw)
    return plain(cleanse.typed_lines(text))


@query
def etl_reject_funnel(spark, sf_dir):
    return cleanse.reject_funnel(open_warehouse(spark, sf_dir).typed)


@query
def etl_quarantine(spark, sf_dir):
    return plain(cleanse.rejected_lines(open_warehouse(spark, sf_dir).typed))


@query
def etl_dedup(spark, sf_dir):
    typed = open_warehouse(spark, sf_dir).typed
    return plain(typed.where(cleanse.row_reject_reason().isNull()).dropDuplicates())


@query
def etl_clean_lines(spark, sf_dir):
    return plain(cleanse.clean_lines(open_warehouse(spark, sf_dir).typed))


@query
def etl_enriched(spark, sf_dir):
    lines = cleanse.with_order_quantity(cleanse.clean_lines(open_warehouse(spark, sf_dir).typed))
    return plain(cleanse.with_date_parts(lines)).drop(
        "Description", "InvoiceDate", "UnitPrice", "CustomerID", "Country"
    )


@query
def enrich_customer_value(spark, sf_dir):
    lines = cleanse.with_customer_value(open_warehouse(spark, sf_dir).lines, VALUE_STEPS)
    return lines.groupBy("CustomerID", "CustomerSegment").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("TotalRevenue").cast("double").alias("revenue")
    )


@query
def fn_clean_text(spark, sf_dir):
    key = F.col("p_partkey")
    dirty = F.when(key % 7 == 0, "   ").when(key % 7 == 1, " NaN ").otherwise(F.concat(F.lit("  "), "p_name", F.lit(" ")))
    parts = retail.read_table(spark, sf_dir, "part")
    return parts.groupBy(clean_text(dirty).alias("cleaned")).agg(F.count(F.lit(1)).alias("records"))


@query
def fn_validate(spark, sf_dir):
    key = F.col("l_orderkey")
    quantity = F.when(key % 11 == 0, "n/a").when(key % 50 == 7, (-F.col("l_quantity")).cast("string")).otherwise(
        F.col("l_quantity").cast("string"))
    price = F.when(key % 13 == 0, "free").otherwise(F.col("l_extendedprice").cast("string"))
    return retail.read_table(spark, sf_dir, "lineitem").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(in_range(quantity, config.MIN_QUANTITY, config.MAX_QUANTITY)).alias("valid_quantity"),
        F.count_if(in_range(price, config.MIN_UNIT_PRICE, config.MAX_UNIT_PRICE)).alias("valid_price"),
    )


# --- dimensions and fact ----------------------------------------------------------------
@query
def dim_date(spark, sf_dir):
    return dims.dim_date(open_warehouse(spark, sf_dir).lines)


@query
def dim_date_basic(spark, sf_dir):
    return dims.dim_date_basic(open_warehouse(spark, sf_dir).lines)


@query
def dim_location(spark, sf_dir):
    return plain(dims.dim_location(open_warehouse(spark, sf_dir).lines, retail.country_lookup(spark, sf_dir)))


@query
def dim_customer(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    s = w.settings
    return plain(dims.dim_customer(w.lines, s.as_of_column(), s.monetary_bins, s.tier_bins, s.recency_bins))


@query
def dim_customer_basic(spark, sf_dir):
    return plain(dims.dim_customer_basic(open_warehouse(spark, sf_dir).lines, VALUE_STEPS))


@query
def dim_product(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    return plain(dims.dim_product(w.lines, w.settings.product_classes))


@query
def dim_product_basic(spark, sf_dir):
    return plain(dims.dim_product_basic(open_warehouse(spark, sf_dir).lines, BASIC_CLASSES))


@query
def surrogate_keys(spark, sf_dir):
    lines = open_warehouse(spark, sf_dir).lines
    people = lines.where(F.col("CustomerID") != config.UNKNOWN).select("CustomerID").distinct()
    goods = lines.select("StockCode").distinct()
    return dense_key(people, "CustomerID", "surrogate_key").select(
        F.lit("customer").alias("dimension"), F.col("CustomerID").alias("natural_key"), "surrogate_key"
    ).unionByName(dense_key(goods, "StockCode", "surrogate_key").select(
        F.lit("product").alias("dimension"), F.col("StockCode").alias("natural_key"), "surrogate_key"
    ))


@query
def fact_sales(spark, sf_dir):
    return plain(open_warehouse(spark, sf_dir).assemble_fact())


_EXTENDED: dict[str, str] = {}


def _extended_root(spark, sf_dir) -> str:
    """A star loaded up to a day and extended from that day on, with kept aggregates; once per session and source."""
    w = open_warehouse(spark, sf_dir)
    if w.root not in _EXTENDED:
        raw, geo = w.raw, retail.country_lookup(spark, sf_dir)
        root, day = work_dir(spark, f"incremental-{uuid4().hex}"), F.lit("1998-01-15").cast("timestamp_ntz")
        older = raw.where((F.col("InvoiceDate") < day) | F.col("InvoiceDate").isNull())
        etl.load(spark, older, root, DRIVER_SETTINGS, geo, keep_aggregates=True, dealt=w.dealt)
        release(spark)
        etl.load(spark, raw, root, DRIVER_SETTINGS, geo, since="1998-01-15", dealt=w.dealt)
        release(spark)
        _EXTENDED[w.root] = root
    return _EXTENDED[w.root]


@query
def incr_load(spark, sf_dir):
    """The star after a load up to a day and a second one from that day on, by natural keys."""
    s = etl.open_star(spark, _extended_root(spark, sf_dir))
    joined = s.fact.join(s.date, "DateKey").join(sinks.hashed(s.customer.select("CustomerKey", "CustomerID")), "CustomerKey").join(
        sinks.hashed(s.product.select("ProductKey", "StockCode")), "ProductKey").join(
        s.location.select("LocationKey", "Country"), "LocationKey")
    return plain(joined.select("InvoiceNo", "StockCode", "CustomerID", "Country", "FullDate", "Quantity", "UnitPrice",
                               "TotalRevenue", "OrderQuantity"))


def _broken_dims(w) -> dict[str, DataFrame]:
    """Dimensions with members taken out, so that key checks find something."""
    return {
        "DimDate": w.date.where("Month <> 7"),
        "DimCustomer": w.customer.where("CustomerKey % 25 <> 3"),
        "DimProduct": w.product.where("ProductKey % 10 <> 0"),
        "DimLocation": w.location,
    }


@query
def fact_fk_missing(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    keyed = fact.lookup_keys(
        w.lines, w.date.where("Month <> 7"), w.customer.where("CustomerKey % 25 <> 0 OR CustomerKey = 0"),
        w.product.where("ProductKey % 10 <> 0"), w.location,
    )
    return fact.missing_keys(keyed)


def _bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    path = work_dir(df.sparkSession, f"{name}-{uuid4().hex}")
    return sinks.write_bucketed(df, path, [key], shuffle_width(df.sparkSession))


@query
def fact_fk_bucketed(spark, sf_dir):
    """The key lookup against customers and products that lie by their natural keys."""
    w = open_warehouse(spark, sf_dir)
    people = _bucketed(w.customer.where("CustomerKey % 25 <> 0 OR CustomerKey = 0"), "customers", "CustomerID")
    goods = _bucketed(w.product.where("ProductKey % 10 <> 0"), "products", "StockCode")
    return fact.missing_keys(fact.lookup_keys(w.lines, w.date.where("Month <> 7"), people, goods, w.location))


@query
def incr_new_lines(spark, sf_dir):
    """Lines by month that a history up to 1998 does not hold, against that history bucketed by line."""
    lines = open_warehouse(spark, sf_dir).lines
    keyed = fact.with_line_key(lines, config.REQUIRED_COLUMNS)
    held = _bucketed(keyed.where("InvoiceDate < '1998-01-01'").select("LineKey"), "held", "LineKey")
    fresh = fact.new_lines(keyed, held)
    return plain(fresh.groupBy(F.year("InvoiceDate").alias("sale_year"), F.month("InvoiceDate").alias("sale_month")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum("Quantity").cast("bigint").alias("pieces"),
        F.sum("TotalRevenue").cast("decimal(38,2)").alias("revenue")))


@query
def fact_validation(spark, sf_dir):
    return cleanse.fact_validation(open_warehouse(spark, sf_dir).fact, 40, 950)


@query
def fact_unknown_fanout(spark, sf_dir):
    return fact.unknown_fanout(open_warehouse(spark, sf_dir).lines).groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("line_count"), F.sum("TotalRevenue").cast("double").alias("revenue")
    )


# --- key figures -------------------------------------------------------------------------
def _kpi(name: str, fn, *args) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(star(spark, sf_dir), *args)


_kpi("kpi_global", kpi.global_kpis)
_kpi("kpi_overview_filtered", kpi.overview, FILTERS)
_kpi("kpi_date_range", kpi.overview, DATES)
_kpi("kpi_monthly", kpi.monthly)
_kpi("kpi_monthly_filtered", kpi.monthly_filtered, FILTERS)
_kpi("kpi_segments", kpi.segments)
_kpi("kpi_top_customers", kpi.top_customers)
_kpi("kpi_top_products_filtered", kpi.top_products_filtered, FILTERS)
_kpi("kpi_categories", kpi.categories)
_kpi("kpi_countries", kpi.countries)
_kpi("kpi_regions", kpi.regions)
_kpi("kpi_region_rollup", kpi.region_rollup)
_kpi("kpi_country_totals", kpi.country_totals)
_kpi("kpi_top_products", kpi.top_descriptions)
_kpi("kpi_top_products_qty", kpi.top_descriptions_by_quantity)
_kpi("kpi_customers_by_country", kpi.customers_by_country)
_kpi("kpi_day_of_week", kpi.day_of_week)
_kpi("kpi_date_bounds", kpi.date_bounds)
_kpi("wh_table_counts", kpi.table_counts)
_kpi("wh_sanity", kpi.sanity)
_kpi("wh_summary", kpi.summary)


@query
def load_summary(spark, sf_dir):
    return sinks.load_summary(star(spark, sf_dir).tables(), RUN_ID)


@query
def load_roundtrip(spark, sf_dir):
    """Rows and key sums of every table as written."""
    keys = {
        "DimDate": "DateKey", "DimCustomer": "CustomerKey", "DimProduct": "ProductKey", "DimLocation": "LocationKey",
        "DimChannel": "ChannelKey", "FactSales": "DateKey + CustomerKey + ProductKey + LocationKey",
    }
    out = None
    for name, df in star(spark, sf_dir).tables().items():
        one = df.agg(F.count(F.lit(1)).alias("records"), F.sum(F.expr(keys[name])).cast("bigint").alias("key_sum"))
        one = one.select(F.lit(name).alias("table_name"), "records", "key_sum")
        out = one if out is None else out.unionByName(one)
    return out


@query
def lineage_log(spark, sf_dir):
    """Record counts of the two load stages, observed while they are written.

    Lines stay by invoice from the raw zone to their buyers; the dimensions are those of the lines just written.
    """
    w = open_warehouse(spark, sf_dir)
    log = lineage.Lineage(spark, RUN_ID)
    path = work_dir(spark, f"lineage-{uuid4().hex}")
    raw = w.raw
    release(spark)
    lines = log.write(raw, "RawLines", lambda raw: cleanse.with_order_quantity(
        cleanse.clean_lines(cleanse.typed_lines(raw)), "shuffle_hash"), "CleanLines", f"{path}/lines", "Transform",
        by_invoice=w.dealt)
    m = w.members_of(lines, f"{path}/members")
    bought = fact.with_buyer(lines, m.customer, "shuffle_hash", w.dealt)
    dims_of = (m.date, m.customer, m.product, m.location)
    release(spark)
    log.write(bought, "CleanLines", lambda x: fact.lookup_keys(x, *dims_of).na.drop(
        subset=fact.FOREIGN_KEYS), "FactSales", f"{path}/fact", "Load")
    return log.frame().select("SourceTable", "TargetTable", "SourceRecordCount", "TargetRecordCount",
                              "TransformationType", "Status")


# --- business reports --------------------------------------------------------------------------
def _rfm(s):
    return analytics.rfm(s, as_of(), **RFM_CUTS)


@query
def rfm(spark, sf_dir):
    return _rfm(star(spark, sf_dir))


@query
def rfm_summary(spark, sf_dir):
    return analytics.rfm_summary(_rfm(star(spark, sf_dir)))


@query
def clv(spark, sf_dir):
    return analytics.clv(star(spark, sf_dir), CLV_TIERS)


@query
def clv_summary(spark, sf_dir):
    return analytics.clv_summary(clv(spark, sf_dir))


@query
def clv_histogram(spark, sf_dir):
    return analytics.histogram(clv(spark, sf_dir), "TotalRevenue", 20)


@query
def clv_box(spark, sf_dir):
    stats = analytics.box_stats(clv(spark, sf_dir), "TotalRevenue", "CustomerTier")
    return rounded(stats, "q1", "median", "q3", "lower_fence", "upper_fence")


@query
def product_performance(spark, sf_dir):
    return analytics.product_performance(star(spark, sf_dir), PRODUCT_GRADES)


@query
def product_category_summary(spark, sf_dir):
    return analytics.product_category_summary(product_performance(spark, sf_dir))


@query
def product_value_counts(spark, sf_dir):
    return analytics.product_value_counts(product_performance(spark, sf_dir))


@query
def product_meaningful(spark, sf_dir):
    return analytics.product_meaningful(product_performance(spark, sf_dir))


@query
def product_top50(spark, sf_dir):
    return analytics.product_top(product_performance(spark, sf_dir), 50)


@query
def seasonal(spark, sf_dir):
    return analytics.seasonal(star(spark, sf_dir))


@query
def geographic(spark, sf_dir):
    return analytics.geographic(star(spark, sf_dir), MARKETS)


@query
def cohort_literal(spark, sf_dir):
    return analytics.cohort_literal(star(spark, sf_dir))


@query
def cohort_retention(spark, sf_dir):
    return analytics.cohort_retention(star(spark, sf_dir))


@query
def insights(spark, sf_dir):
    s = star(spark, sf_dir)
    return analytics.insights(
        _rfm(s), analytics.clv(s, CLV_TIERS), analytics.product_performance(s, PRODUCT_GRADES),
        analytics.geographic(s, MARKETS),
    )


# --- declared tables --------------------------------------------------------------------------------
@query
def agg_daily_sales(spark, sf_dir):
    return aggregates.daily_sales(star(spark, sf_dir).fact)


@query
def agg_monthly_sales(spark, sf_dir):
    return aggregates.monthly_sales(star(spark, sf_dir).fact)


def _by_members(table: DataFrame, s) -> DataFrame:
    """An aggregate table with the natural keys of its customer and location."""
    return table.join(sinks.hashed(s.customer.select("CustomerKey", "CustomerID")), "CustomerKey").join(
        s.location.select("LocationKey", "Country"), "LocationKey").drop("CustomerKey", "LocationKey")


@query
def agg_daily_kept(spark, sf_dir):
    """The daily table as an incremental load has kept it: months that it did not touch come from the load before."""
    root = _extended_root(spark, sf_dir)
    s = etl.open_star(spark, root)
    daily = _by_members(etl.open_aggregates(spark, root)["AggDailySales"], s)
    return plain(daily.join(s.date.select("DateKey", "FullDate"), "DateKey").drop("DateKey"))


@query
def agg_monthly_kept(spark, sf_dir):
    root = _extended_root(spark, sf_dir)
    return plain(_by_members(etl.open_aggregates(spark, root)["AggMonthlySales"], etl.open_star(spark, root)))


@query
def behavior_sessions(spark, sf_dir):
    return aggregates.sessions(retail.read_table(spark, sf_dir, "events")).drop("session", "micros")


@query
def behavior_daily(spark, sf_dir):
    return aggregates.customer_behavior(retail.read_table(spark, sf_dir, "events"))


@query
def inventory_snapshot(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    day = F.to_date("InvoiceDate").alias("day")
    sold = w.lines.select("StockCode", "Country", day, F.col("Quantity").alias("pieces"), "UnitPrice")
    returned = w.typed.where(
        (cleanse.row_reject_reason() == "invalid_quantities") & (F.col("Quantity") < 0) & F.col("InvoiceDate").isNotNull()
    ).select("StockCode", "Country", day, (-F.col("Quantity")).alias("pieces"), "UnitPrice")
    return aggregates.inventory(sold, returned, retail.receipts(spark, sf_dir))


# --- features ------------------------------------------------------------------------------------------
@query
def feat_segmentation(spark, sf_dir):
    return features.segmentation_features(star(spark, sf_dir), as_of())


@query
def feat_scaled(spark, sf_dir):
    scaled = features.standardized(feat_segmentation(spark, sf_dir), config.SEGMENT_FEATURES)
    return scaled.select("CustomerKey", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in config.SEGMENT_FEATURES])


@query
def feat_churn(spark, sf_dir):
    return features.churn_features(features.ml_customers(star(spark, sf_dir)), as_of())


@query
def feat_invoice(spark, sf_dir):
    found = features.invoice_features(features.ml_sales(star(spark, sf_dir)))
    return rounded(found, "TotalRevenue_Std", "Quantity_Std", "UnitPrice_Std")


@query
def ts_daily(spark, sf_dir):
    return features.daily_series(features.ml_sales(star(spark, sf_dir)))


@query
def ts_weekly(spark, sf_dir):
    return features.resampled(ts_daily(spark, sf_dir), "week")


@query
def ts_monthly(spark, sf_dir):
    return features.resampled(ts_daily(spark, sf_dir), "month")


@query
def feat_describe(spark, sf_dir):
    table = _segment_features(spark, sf_dir)
    return rounded(features.describe(table, config.SEGMENT_FEATURES), "mean", "std", "q25", "q50", "q75")


# --- data quality ----------------------------------------------------------------------------------------
RAW_REQUIRED = {"RawLines": config.REQUIRED_COLUMNS}


def _loaded_at():
    return F.lit("2001-09-01 00:00:00").cast("timestamp_ntz")


@query
def dq_completeness(spark, sf_dir):
    raw = open_warehouse(spark, sf_dir).raw
    return quality.evaluate(raw, "RawLines", quality.completeness_rules(raw, "RawLines", RAW_REQUIRED))


@query
def dq_accuracy(spark, sf_dir):
    raw = open_warehouse(spark, sf_dir).raw
    return quality.evaluate(raw, "RawLines", quality.accuracy_rules(raw))


@query
def dq_date_range(spark, sf_dir):
    raw = open_warehouse(spark, sf_dir).raw
    return quality.evaluate(raw, "RawLines", quality.date_rules(raw, {"InvoiceDate": ("1996-01-01", "2000-12-31")}))


@query
def dq_consistency(spark, sf_dir):
    """With the revenue of 17-piece lines changed, so that the check finds something."""
    wrong = F.when(F.col("Quantity") == 17, F.col("TotalRevenue") + 1).otherwise(F.col("TotalRevenue"))
    lines = open_warehouse(spark, sf_dir).lines.withColumn("TotalRevenue", wrong)
    return quality.evaluate(lines, "FactSales", quality.consistency_rules(lines, "FactSales"))


@query
def dq_validity(spark, sf_dir):
    raw = open_warehouse(spark, sf_dir).raw
    return quality.evaluate(raw, "RawLines", quality.validity_rules(raw))


@query
def dq_uniqueness(spark, sf_dir):
    return quality.uniqueness(open_warehouse(spark, sf_dir).raw, "RawLines", ["InvoiceNo", "StockCode"])


@query
def dq_all(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    return quality.run_all_checks(w.raw, "RawLines", ["InvoiceNo"]).unionByName(
        quality.run_all_checks(w.fact, "FactSales")
    )


@query
def dq_log(spark, sf_dir):
    return quality.as_log(dq_all(spark, sf_dir), RUN_ID, _loaded_at())


@query
def dq_log_summary(spark, sf_dir):
    return quality.log_summary(dq_log(spark, sf_dir))


@query
def dq_recent_issues(spark, sf_dir):
    return quality.recent_issues(dq_log(spark, sf_dir))


@query
def dq_summary(spark, sf_dir):
    return quality.quality_summary(dq_log(spark, sf_dir))


@query
def dq_gate(spark, sf_dir):
    """The gate over completeness, with the customer of large lines removed."""
    lost = F.when(F.col("Quantity") > 45, None).otherwise(F.col("CustomerID"))
    raw = open_warehouse(spark, sf_dir).raw.withColumn("CustomerID", lost)
    return quality.load_gate(quality.evaluate(raw, "RawLines", quality.completeness_rules(raw, "RawLines", RAW_REQUIRED)))


@query
def dq_score(spark, sf_dir):
    return quality.quality_score(quality.run_all_checks(open_warehouse(spark, sf_dir).fact, "FactSales"))


@query
def dq_score_failed_only(spark, sf_dir):
    raw = open_warehouse(spark, sf_dir).raw
    return quality.quality_score(quality.run_all_checks(raw, "RawLines", ["InvoiceNo"]), failed_only=True)


@query
def dq_frame_metrics(spark, sf_dir):
    return quality.frame_metrics(open_warehouse(spark, sf_dir).raw)


@query
def dq_timeliness(spark, sf_dir):
    return quality.timeliness(open_warehouse(spark, sf_dir).raw, "RawLines", "InvoiceDate", as_of(), 30)


@query
def dq_score_stats(spark, sf_dir):
    return quality.score_stats(star(spark, sf_dir).fact)


@query
def dq_bad_rows(spark, sf_dir):
    return quality.bad_rows(star(spark, sf_dir).fact)


@query
def dq_orphans(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    return quality.orphan_rows(w.fact, _broken_dims(w))


@query
def dq_referential(spark, sf_dir):
    w = open_warehouse(spark, sf_dir)
    return quality.referential(w.fact, _broken_dims(w))


# --- profiling ---------------------------------------------------------------------------------------------
@query
def profile_numeric(spark, sf_dir):
    return rounded(profile.profile_numeric(open_warehouse(spark, sf_dir).raw), "median_value", "std_value")


@query
def profile_string(spark, sf_dir):
    return profile.profile_string(open_warehouse(spark, sf_dir).raw)


@query
def profile_date(spark, sf_dir):
    return profile.profile_date(open_warehouse(spark, sf_dir).raw)


@query
def profile_merged(spark, sf_dir):
    """The profile from sketches per month: exact figures as they are, estimates held against all values."""
    lines = open_warehouse(spark, sf_dir).lines
    columns = list(sketches.COLUMNS)
    months = sinks.write_table(sketches.month_sketches(lines), work_dir(spark, f"sketches-{uuid4().hex}"))
    merged = sketches.merge(months)
    counts = profile.value_counts(lines, columns, "string")
    number = F.when(F.col("data_type") == "string", F.length("v").cast("double")).otherwise(F.col("v").cast("double"))
    beside = counts.where("v IS NOT NULL").join(merged.select("column_name", "data_type", "median_estimate"), "column_name")
    placed = beside.withColumn("m", number).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("uniques"), F.sum("n").alias("seen"),
        F.sum(F.when(F.col("m") < F.col("median_estimate"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("m") <= F.col("median_estimate"), F.col("n")).otherwise(0)).alias("upto"),
    )
    near = F.abs(F.col("unique_estimate") - F.col("uniques")) <= F.col("uniques") * sketches.UNIQUE_ERROR
    middle = (F.col("below") <= F.col("seen") * (0.5 + sketches.RANK_ERROR)) & (
        F.col("upto") >= F.col("seen") * (0.5 - sketches.RANK_ERROR))
    return rounded(merged.join(placed, "column_name").select(
        "column_name", "data_type", "records", "null_count", "min_value", "max_value", "mean_value", "std_value",
        "zero_count", "negative_count", near.alias("unique_within"), middle.alias("median_within")),
        "mean_value", "std_value")


@query
def outlier_bounds(spark, sf_dir):
    bounds = profile.outlier_bounds(open_warehouse(spark, sf_dir).lines, ["Quantity", "UnitPrice", "TotalRevenue"])
    return rounded(bounds, "q1", "q3", "lower_bound", "upper_bound")


@query
def outliers_iqr(spark, sf_dir):
    found = profile.detect_outliers(open_warehouse(spark, sf_dir).typed, ["Quantity", "UnitPrice"])
    return plain(found.select("InvoiceNo", "StockCode", "Quantity", "UnitPrice",
                              F.concat_ws(",", "outlier_columns").alias("outlier_columns")))


# --- models ---------------------------------------------------------------------------------------------------
SEGMENT_NAMES = [
    ("Champions", 100, None, 41, None, 860000), ("Loyal Customers", 110, None, 38, None, 500000),
    ("Potential Loyalists", 100, None, None, 41, 500000), ("At Risk", None, 100, 5, None, 500000),
]


def _written(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A model input or result written to a folder of this call and read back."""
    return sinks.write_table(build(), work_dir(spark, "ml", f"{name}-{uuid4().hex}"))


def _segment_features(spark, sf_dir):
    return _written(spark, sf_dir, "segmentation", lambda: feat_segmentation(spark, sf_dir))


@query
def ml_segment_stats(spark, sf_dir):
    segmented = feat_segmentation(spark, sf_dir).withColumn("Segment", (F.col("CustomerKey") % 6 - 1).cast("int"))
    return kmeans.segment_stats(segmented, names=SEGMENT_NAMES)


@query
def ml_kmeans(spark, sf_dir):
    table = _segment_features(spark, sf_dir)
    return kmeans.predict(kmeans.train(table), table)


def _density_segments(spark, sf_dir):
    scaled = _written(spark, sf_dir, "scaled", lambda: feat_scaled(spark, sf_dir))
    return dbscan.segment(_segment_features(spark, sf_dir), scaled, eps=0.5, min_samples=5)


@query
def ml_dbscan(spark, sf_dir):
    """Density segment of every customer; -1 is noise."""
    return _density_segments(spark, sf_dir).select("CustomerKey", "Segment")


@query
def ml_dbscan_stats(spark, sf_dir):
    return kmeans.segment_stats(_density_segments(spark, sf_dir), names=SEGMENT_NAMES)


@query
def model_roundtrip(spark, sf_dir):
    """A saved and loaded model against the one in memory: customers and differing segments."""
    table = _segment_features(spark, sf_dir)
    model = kmeans.train(table, restarts=2)
    path = work_dir(spark, "models", uuid4().hex)
    model.write().save(path)
    again = PipelineModel.load(path)
    both = kmeans.predict(model, table).select("CustomerKey", "Segment").join(
        kmeans.predict(again, table).select("CustomerKey", F.col("Segment").alias("Loaded")), "CustomerKey"
    )
    return both.agg(F.count(F.lit(1)).alias("customers"), F.count_if(F.col("Segment") != F.col("Loaded")).alias("differing"))


@query
def ml_churn(spark, sf_dir):
    table = _written(spark, sf_dir, "churn", lambda: feat_churn(spark, sf_dir))
    return churn.predict(churn.train(table, cross_validate=False).model, table)


@query
def ml_churn_confusion(spark, sf_dir):
    table = _written(spark, sf_dir, "churn_confusion", lambda: feat_churn(spark, sf_dir))
    return churn.classification_report(churn.train(table, cross_validate=False).confusion)


@query
def ml_churn_metrics(spark, sf_dir):
    """Accuracy, the five fold scores and the importance of every feature: (metric, name, value)."""
    table = _written(spark, sf_dir, "churn_metrics", lambda: feat_churn(spark, sf_dir))
    return churn.metrics(churn.train(table), spark)


@query
def ml_confusion_metrics(spark, sf_dir):
    """The report for a plain rule: more than 0.4 orders per day since the last purchase means active."""
    guess = F.when(F.col("OrderFrequency") > 0.4, 0).otherwise(1)
    scored = feat_churn(spark, sf_dir).withColumn("guess", guess)
    return churn.classification_report(churn.confusion_counts(scored, "IsChurned", "guess"))


@query
def fc_arima(spark, sf_dir):
    return forecast.fit_models(_series(spark, sf_dir), ("ARIMA",))


@query
def fc_holt_winters(spark, sf_dir):
    return forecast.fit_models(_series(spark, sf_dir), ("HoltWinters",))


@query
def fc_forecast(spark, sf_dir):
    return forecast.forecast(_series(spark, sf_dir), 30)


@query
def fits_roundtrip(spark, sf_dir):
    """Kept fits against fits in memory: forecast rows of both and rows that differ."""
    fits = _written(spark, sf_dir, "fits", lambda: forecast.fit_models(_series(spark, sf_dir)))
    path = work_dir(spark, "models", uuid4().hex)
    fits.write.parquet(path)
    rows = forecast.forecast_from(fits, 30)
    again = forecast.forecast_from(spark.read.parquet(path), 30)
    changed = rows.exceptAll(again).agg(F.count(F.lit(1))).scalar()
    return rows.agg(F.count(F.lit(1)).alias("forecasts")).withColumn("differing", changed)


@query
def fc_series(spark, sf_dir):
    return _series(spark, sf_dir)


def _series(spark, sf_dir):
    s = star(spark, sf_dir)
    rows = kpi.sales(s, date=("FullDate",), location=("Country",)).withColumnRenamed("FullDate", "InvoiceDate")
    return forecast.daily_by_series(rows, "Country")


def _invoice_forest(spark, sf_dir):
    table = _written(spark, sf_dir, "invoice", lambda: feat_invoice(spark, sf_dir))
    nodes = iforest.train(table, config.INVOICE_FEATURES, ["InvoiceNo"])
    scored = iforest.with_score(table, nodes, config.INVOICE_FEATURES, "AnomalyScore")
    return _written(spark, sf_dir, "invoice_scores", lambda: scored)


@query
def forest_roundtrip(spark, sf_dir):
    """A saved and loaded forest against the one in memory: invoices and differing scores."""
    table = _written(spark, sf_dir, "invoice", lambda: feat_invoice(spark, sf_dir))
    nodes = _written(spark, sf_dir, "forest", lambda: iforest.train(table, config.INVOICE_FEATURES, ["InvoiceNo"]))
    path = work_dir(spark, "models", uuid4().hex)
    iforest.save(nodes, config.INVOICE_FEATURES, path)
    again, columns = iforest.load(spark, path)
    scores = iforest.with_score(table, nodes, config.INVOICE_FEATURES, "score").select("InvoiceNo", "score")
    loaded = iforest.with_score(table, again, columns, "score").select("InvoiceNo", F.col("score").alias("loaded"))
    both = scores.join(loaded, "InvoiceNo")
    return both.agg(F.count(F.lit(1)).alias("invoices"), F.count_if(F.col("score") != F.col("loaded")).alias("differing"))


@query
def ml_iforest(spark, sf_dir):
    return iforest.flag(_invoice_forest(spark, sf_dir), "AnomalyScore", "IsAnomaly", 0.1)


@query
def ml_line_anomaly(spark, sf_dir):
    """Flags of the lines on quantity, price and revenue, each judged alone; with their counts per column."""
    names = ["Quantity", "UnitPrice", "TotalRevenue"]
    lines = open_warehouse(spark, sf_dir).lines
    scored = lines
    for c in names:
        nodes = iforest.train(lines, [c], ["InvoiceNo", "StockCode", "Quantity"])
        scored = iforest.with_score(scored, nodes, [c], f"{c}_anomaly_score")
    scored = _written(spark, sf_dir, "line_scores", lambda: scored)
    for c in names:
        scored = iforest.flag(scored, f"{c}_anomaly_score", f"{c}_anomaly")
    return plain(scored)


@query
def ml_run_status(spark, sf_dir):
    """Status of the four analyses."""
    table = _segment_features(spark, sf_dir)
    return runner.run_all(spark, star(spark, sf_dir).fact, {
        "customer_segmentation": lambda: kmeans.segment_stats(kmeans.predict(kmeans.train(table, restarts=2), table)),
        "churn_prediction": lambda: ml_churn(spark, sf_dir),
        "demand_forecasting": lambda: fc_forecast(spark, sf_dir),
        "anomaly_detection": lambda: ml_iforest(spark, sf_dir),
    })


# --- streams: everything in the source is processed, the result table is read back -----------------------------
WIDE_WATERMARK = "40 days"


def _line_stream(spark, sf_dir, files_per_batch: int | None = 2):
    w = open_warehouse(spark, sf_dir)
    return jobs.read_stream(spark, f"{w.root}/raw", w.raw.schema, files_per_batch)


def _event_stream(spark, sf_dir):
    schema = retail.read_table(spark, sf_dir, "events").schema
    # a pattern reads a single file as well as a folder of files
    return jobs.read_stream(spark, f"{sf_dir}/events.parque[t]", schema)


@query
def st_cleanse(spark, sf_dir):
    return plain(jobs.drain_append(jobs.cleansed(_line_stream(spark, sf_dir)), "cleanse"))


@query
def st_dedup(spark, sf_dir):
    """Every event arrives twice and is kept once."""
    doubled = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    once = jobs.drain_append(jobs.deduplicated(doubled, "ts", ["event_id"], WIDE_WATERMARK), "dedup")
    return once.select("event_id", "user_id", "event_type", "value")


@query
def st_enrich(spark, sf_dir):
    """Each micro-batch reads the dimensions, which grow with the lines: batches of bytes, not of two files."""
    s = star(spark, sf_dir)
    keyed = jobs.enriched(jobs.cleansed(_line_stream(spark, sf_dir, None)), s).select(
        "InvoiceNo", "DateKey", "CustomerKey", "ProductKey", "LocationKey", "Quantity", "TotalRevenue"
    )
    return plain(jobs.drain_append(keyed, "enrich"))


@query
def st_tumbling(spark, sf_dir):
    events = _event_stream(spark, sf_dir)
    windows = jobs.windowed(events, "ts", "value", "1 hour", None, WIDE_WATERMARK)
    return jobs.drain_upsert(windows, "tumbling", ["window_start", "window_end"])


@query
def st_sliding(spark, sf_dir):
    events = _event_stream(spark, sf_dir)
    windows = jobs.windowed(events, "ts", "value", "1 hour", "15 minutes", WIDE_WATERMARK)
    return jobs.drain_upsert(windows, "sliding", ["window_start", "window_end"])


@query
def st_tumbling_late(spark, sf_dir):
    """Append mode with a one-hour watermark: closed windows only, late events dropped.

    The newer half of the events (from the middle of their time range on) is processed
    first; the older half arrives after that and is late.
    """
    events = retail.read_table(spark, sf_dir, "events")
    root = work_dir(spark, "stream", f"late-{uuid4().hex}")
    ends = events.agg(F.unix_seconds(F.min("ts").cast("timestamp")).alias("a"),
                      F.unix_seconds(F.max("ts").cast("timestamp")).alias("b"))
    cut = ends.select(F.timestamp_seconds(F.floor((F.col("a") + F.col("b")) / 2)).cast("timestamp_ntz")).scalar()
    out = None
    for part in (events.where(F.col("ts") >= cut), events.where(F.col("ts") < cut)):
        part.write.mode("append").parquet(f"{root}/events")
        stream = jobs.read_stream(spark, f"{root}/events", events.schema)
        out = jobs.drain_append(jobs.windowed(stream, "ts", "value"), "late", root)
    return out


@query
def st_sessions(spark, sf_dir):
    """Sessions the watermark has closed, and those still held in the state at the end of the input."""
    closed, still = sessions.drain(_event_stream(spark, sf_dir), "sessions", "ts", "user_id", 1800, WIDE_WATERMARK)
    return sessions.named(closed.unionByName(still), "user_id")


@query
def st_gate_load(spark, sf_dir):
    """Lines per outcome when each micro-batch must pass the completeness gate.

    The customer is optional in a line. Its share of nulls lies at the limit, so
    the outcome would depend on which files form a batch.
    """
    required = {"RawLines": [c for c in config.REQUIRED_COLUMNS if c != "CustomerID"]}
    loaded = jobs.gated_load(
        _line_stream(spark, sf_dir), lambda b: quality.completeness_rules(b, "RawLines", required), "RawLines"
    )
    return loaded.groupBy("outcome").agg(F.count(F.lit(1)).alias("records"))
