"""Data-quality checks: one aggregate over the table, one row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart import config

CHECK_COLUMNS = [
    "check_name", "table_name", "check_type", "severity", "records_checked",
    "records_failed", "failure_rate", "error_message",
]


# Check names and messages below are fixed values: reports and logs are read by them.
def _check(name: str, kind: str, failed: Column, message: Column, always: bool) -> dict:
    return {"name": name, "kind": kind, "failed": failed, "message": message, "always": always}


def completeness_rules(df: DataFrame, table: str, required: dict | None = None) -> list[dict]:
    """Nulls per required column; always reported."""
    columns = (required or config.DQ_REQUIRED).get(table, [])
    return [
        _check(
            f"Completeness_{c}", "completeness", F.col(c).isNull(),
            F.format_string(
                f"Column {c} has %d null values (%.2f%% completeness)", F.col("records_failed"),
                F.coalesce(F.try_divide((F.col("records_checked") - F.col("records_failed")) * 100.0, F.col("records_checked")),
                           F.lit(100.0)),
            ),
            True,
        )
        for c in columns if c in df.columns
    ]


def accuracy_rules(df: DataFrame, ranges: dict | None = None) -> list[dict]:
    """Values outside a numeric range; nulls do not count; always reported."""
    return [
        _check(
            f"Accuracy_{c}_Range", "accuracy", (F.col(c) < F.lit(low)) | (F.col(c) > F.lit(high)),
            F.format_string(f"Column {c} has %d values outside range [{low}, {high}]", F.col("records_failed")),
            True,
        )
        for c, (low, high) in (ranges or config.DQ_RANGES).items() if c in df.columns
    ]


def date_rules(df: DataFrame, ranges: dict | None = None) -> list[dict]:
    """Dates outside their range; always reported."""
    return [
        _check(
            f"Accuracy_{c}_DateRange", "accuracy",
            (F.to_date(c) < F.lit(low).cast("date")) | (F.to_date(c) > F.lit(high).cast("date")),
            F.format_string(f"Column {c} has %d values outside range [{low}, {high}]", F.col("records_failed")),
            True,
        )
        for c, (low, high) in (ranges or config.DQ_DATE_RANGES).items() if c in df.columns
    ]


def consistency_rules(df: DataFrame, table: str) -> list[dict]:
    """TotalRevenue against Quantity * UnitPrice; reported only when broken."""
    if table != "FactSales" or not {"Quantity", "UnitPrice", "TotalRevenue"} <= set(df.columns):
        return []
    expected = F.col("Quantity").cast("decimal(10,0)") * F.col("UnitPrice")
    return [_check(
        "Consistency_Revenue_Calculation", "consistency",
        F.abs(F.col("TotalRevenue") - expected) > F.lit(0.01).cast("decimal(3,2)"),
        F.format_string("TotalRevenue calculation inconsistent in %d records", F.col("records_failed")),
        False,
    )]


def validity_rules(df: DataFrame, formats: dict | None = None) -> list[dict]:
    """Text not in its format; nulls read 'nan' and fail; reported only when broken."""
    return [
        _check(
            f"Validity_{c}_Format", "validity",
            ~F.coalesce(F.col(c).cast("string"), F.lit("nan")).rlike(pattern),
            F.format_string(f"Column {c} has %d records with invalid format", F.col("records_failed")),
            False,
        )
        for c, pattern in (formats or config.DQ_FORMATS).items() if c in df.columns
    ]


def _severity(kind: Column, rate: Column) -> Column:
    return (
        F.when(kind == "completeness",
               F.when(1 - rate < config.DQ_COMPLETENESS_THRESHOLD, "critical").otherwise("low"))
        .when(kind == "accuracy", F.when(rate > 0.05, "high").otherwise("medium"))
        .when(kind == "consistency", "critical")
        .when(kind == "validity", F.when(rate < 0.1, "medium").otherwise("high"))
        .otherwise("high")
    )


def evaluate(df: DataFrame, table: str, rules: list[dict]) -> DataFrame:
    """Evaluate all rules in a single scan and turn the counts into rows."""
    if not rules:
        return _empty(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("records_checked"),
        *[F.count_if(F.coalesce(r["failed"], F.lit(False))).alias(f"__f{i}") for i, r in enumerate(rules)],
    )
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("i"), F.lit(r["name"]).alias("check_name"), F.lit(r["kind"]).alias("check_type"),
            F.lit(r["always"]).alias("always"), F.col(f"__f{i}").alias("records_failed"),
        )
        for i, r in enumerate(rules)
    ])
    message = F.lit(None).cast("string")
    for i, r in enumerate(rules):
        message = F.when(F.col("i") == i, r["message"]).otherwise(message)
    flat = counts.select("records_checked", F.explode(rows).alias("r")).select("records_checked", "r.*")
    plain = F.try_divide(F.col("records_failed").cast("double"), F.col("records_checked").cast("double"))
    complement = 1 - F.try_divide(
        (F.col("records_checked") - F.col("records_failed")).cast("double"), F.col("records_checked").cast("double")
    )
    rated = flat.where(F.col("always") | (F.col("records_failed") > 0)).withColumn(
        "failure_rate", F.when(F.col("check_type") == "completeness", complement).otherwise(plain)
    )
    return rated.select(
        "check_name", F.lit(table).alias("table_name"), "check_type",
        _severity(F.col("check_type"), F.col("failure_rate")).alias("severity"),
        "records_checked", "records_failed", "failure_rate", message.alias("error_message"),
    )


def _empty(df: DataFrame) -> DataFrame:
    kinds = {"records_checked": "bigint", "records_failed": "bigint", "failure_rate": "double"}
    return df.sparkSession.range(0).select(
        *[F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in CHECK_COLUMNS])


def uniqueness(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key value, per key column; reported only when broken."""
    out = _empty(df)
    for key in [k for k in keys if k in df.columns]:
        counts = df.agg(F.count(F.lit(1)).alias("records_checked"), F.countDistinct(key).alias("__d"))
        failed = F.col("records_checked") - F.col("__d")
        out = out.unionByName(
            counts.withColumn("records_failed", failed).where("records_failed > 0").select(
                F.lit(f"Uniqueness_{key}").alias("check_name"), F.lit(table).alias("table_name"),
                F.lit("uniqueness").alias("check_type"), F.lit("high").alias("severity"),
                "records_checked", "records_failed",
                F.coalesce(F.try_divide(F.col("records_failed").cast("double"), F.col("records_checked")), F.lit(0.0))
                .alias("failure_rate"),
                F.format_string(f"Column {key} has %d duplicate values", F.col("records_failed")).alias("error_message"),
            )
        )
    return out


def referential(fact: DataFrame, dims: dict[str, DataFrame], keys: dict | None = None) -> DataFrame:
    """Distinct fact keys that no dimension row carries; reported only when broken.

    Keys are made distinct before the anti join, so a key shared by a third of
    the fact costs one row.
    """
    out = _empty(fact)
    total = fact.agg(F.count(F.lit(1))).scalar()
    for key, table in (keys or config.DQ_FOREIGN_KEYS).items():
        if key not in fact.columns or table not in dims:
            continue
        orphans = (
            fact.select(key).where(F.col(key).isNotNull()).distinct()
            .join(dims[table].select(key), key, "left_anti")
            .agg(F.count(F.lit(1)).alias("records_failed"))
        )
        out = out.unionByName(
            orphans.where("records_failed > 0").withColumn("records_checked", total).select(
                F.lit(f"Referential_Integrity_{key}").alias("check_name"), F.lit("FactSales").alias("table_name"),
                F.lit("consistency").alias("check_type"), F.lit("critical").alias("severity"),
                "records_checked", "records_failed",
                F.coalesce(F.try_divide(F.col("records_failed").cast("double"), F.col("records_checked")), F.lit(0.0))
                .alias("failure_rate"),
                F.format_string(f"Found %d orphaned {key} values in FactSales", F.col("records_failed"))
                .alias("error_message"),
            )
        )
    return out


def orphan_rows(fact: DataFrame, dims: dict[str, DataFrame], keys: dict | None = None) -> DataFrame:
    """Fact rows without a matching dimension row, per key: (foreign_key, orphan_rows)."""
    out = None
    for key, table in (keys or config.DQ_FOREIGN_KEYS).items():
        # count rows per key first: the anti join then sees each key once
        per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = per_key.join(dims[table].select(key), key, "left_anti").agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows")
        ).select(F.lit(key).alias("foreign_key"), "orphan_rows")
        out = lost if out is None else out.unionByName(lost)
    return out


def run_all_checks(df: DataFrame, table: str, key_columns: list[str] | None = None, dates: bool = False) -> DataFrame:
    """Every check that applies to the table. All row rules share one scan."""
    rules = completeness_rules(df, table) + accuracy_rules(df) + consistency_rules(df, table) + validity_rules(df)
    if dates:
        rules += date_rules(df)
    checks = evaluate(df, table, rules)
    if not key_columns:
        return checks
    lost = [k for k in key_columns if k not in df.columns]
    if lost:
        raise ValueError(f"{table} has no key column {', '.join(lost)}")
    return checks.unionByName(uniqueness(df, table, key_columns))


def timeliness(df: DataFrame, table: str, column: str, as_of: Column, max_age_days: int) -> DataFrame:
    """Age of the newest value against ``as_of``; fails when older than allowed."""
    age = F.datediff(as_of, F.col("newest"))
    newest = df.agg(F.count(F.lit(1)).alias("records_checked"), F.to_date(F.max(column)).alias("newest"))
    stale = F.coalesce(age > max_age_days, F.lit(True))
    return newest.select(
        F.lit(f"Timeliness_{column}").alias("check_name"), F.lit(table).alias("table_name"),
        F.lit("timeliness").alias("check_type"),
        F.when(stale, "high").otherwise("low").alias("severity"),
        "records_checked",
        F.when(stale, F.col("records_checked")).otherwise(F.lit(0)).cast("bigint").alias("records_failed"),
        F.when(stale, F.lit(1.0)).otherwise(F.lit(0.0)).alias("failure_rate"),
        F.format_string(f"Newest {column} is %d days old", age).alias("error_message"),
    )


def as_log(checks: DataFrame, run_id: str, at: Column) -> DataFrame:
    """Check rows in the layout of the quality log."""
    return checks.select(
        *CHECK_COLUMNS,
        at.cast("timestamp_ntz").alias("check_timestamp"),
        F.lit(run_id).alias("etl_run_id"),
        F.lit(config.DQ_SOURCE_SYSTEM).alias("source_system"),
    )


def quality_summary(log: DataFrame) -> DataFrame:
    """Totals, success rate and counts by severity and type: (section, name, value)."""
    total, failed = F.col("total_checks"), F.col("failed_checks")
    counted = log.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("records_failed") > 0).alias("failed_checks"),
        *[F.count_if(F.col("severity") == s).alias(f"severity_{s}") for s in config.DQ_SEVERITIES],
        *[F.count_if(F.col("check_type") == t).alias(f"type_{t}") for t in config.DQ_CHECK_TYPES],
    )
    rate = F.when(total > 0, (total - failed).cast("double") / total).otherwise(F.lit(0.0))
    rows = [
        ("totals", "total_checks", total.cast("double")),
        ("totals", "failed_checks", failed.cast("double")),
        ("totals", "success_rate", rate),
        *[("severity", s, F.col(f"severity_{s}").cast("double")) for s in config.DQ_SEVERITIES],
        *[("check_type", t, F.col(f"type_{t}").cast("double")) for t in config.DQ_CHECK_TYPES],
    ]
    packed = F.array(*[
        F.struct(F.lit(a).alias("section"), F.lit(b).alias("name"), v.alias("value")) for a, b, v in rows
    ])
    return counted.select(F.explode(packed).alias("r")).select("r.*")


def load_gate(log: DataFrame, critical_threshold: float = 0.05) -> DataFrame:
    """May the load go on? Failed share over the critical checks, and the verdict."""
    critical = F.col("severity") == "critical"
    sums = log.agg(
        F.coalesce(F.sum(F.when(critical, F.col("records_checked"))), F.lit(0)).cast("bigint").alias("critical_checked"),
        F.coalesce(F.sum(F.when(critical, F.col("records_failed"))), F.lit(0)).cast("bigint").alias("critical_failed"),
    )
    rate = F.try_divide(F.col("critical_failed").cast("double"), F.col("critical_checked").cast("double"))
    return sums.select(
        "critical_checked", "critical_failed", F.coalesce(rate, F.lit(0.0)).alias("critical_rate"),
        F.coalesce(rate <= critical_threshold, F.lit(True)).alias("proceed"),
    )


def require_quality(log: DataFrame, critical_threshold: float = 0.05) -> None:
    """Raise when the gate is closed."""
    verdict = load_gate(log, critical_threshold).first()
    if not verdict["proceed"]:
        raise ValueError(f"critical quality failures: {verdict['critical_rate']:.2%} of checked records")


def quality_score(log: DataFrame, failed_only: bool = False) -> DataFrame:
    """Score in [0, 1]: minus 0.2 per critical and 0.05 per other reported check.

    The published rule counts every reported check, also the passed ones;
    ``failed_only`` counts the failed ones.
    """
    counted = log.where("records_failed > 0") if failed_only else log
    critical = F.count_if(F.col("severity") == "critical")
    other = F.count(F.lit(1)) - critical
    loss = critical.cast("double") * 0.2 + other.cast("double") * 0.05
    return counted.agg(F.greatest(F.lit(0.0), 1 - loss).alias("quality_score"))


def frame_metrics(df: DataFrame) -> DataFrame:
    """Missing cells, duplicate rows and share of complete rows of any frame."""
    cells = len(df.columns)
    nulls = sum((F.col(c).isNull().cast("int") for c in df.columns[1:]), F.col(df.columns[0]).isNull().cast("int"))
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")).withColumn("__nulls", nulls)
    sums = groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("__n") * F.col("__nulls")), F.lit(0)).alias("missing_values"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("__nulls") == 0, F.col("__n"))), F.lit(0)).alias("__complete"),
    )
    rows = F.col("total_rows").cast("double")
    return sums.select(
        F.col("total_rows").cast("bigint").alias("total_rows"),
        F.col("missing_values").cast("bigint").alias("missing_values"),
        (F.try_divide(F.col("missing_values").cast("double"), rows * cells) * 100).alias("missing_percentage"),
        F.col("duplicate_rows").cast("bigint").alias("duplicate_rows"),
        (F.try_divide(F.col("__complete").cast("double"), rows) * 100).alias("completeness_score"),
    )


def bad_rows(fact: DataFrame) -> DataFrame:
    """Null keys, negative revenue and non-positive quantity of the fact, in one aggregate."""
    null_key = F.lit(False)
    for key in config.DQ_FOREIGN_KEYS:
        null_key = null_key | F.col(key).isNull()
    return fact.agg(
        F.count_if(null_key).alias("null_keys"),
        F.count_if(F.col("TotalRevenue") < 0).alias("negative_revenue"),
        F.count_if(F.col("Quantity") <= 0).alias("zero_quantity"),
    )


def score_stats(fact: DataFrame) -> DataFrame:
    score = F.col("DataQualityScore")
    return fact.agg(
        (F.sum(score).cast("double") / F.count(score)).alias("AvgQuality"),
        F.min(score).cast("double").alias("MinQuality"),
        F.max(score).cast("double").alias("MaxQuality"),
    )


def log_summary(log: DataFrame) -> DataFrame:
    """Checks by type and severity."""
    return log.groupBy("check_type", "severity").agg(
        F.count(F.lit(1)).alias("CheckCount"),
        F.sum("records_failed").cast("bigint").alias("TotalFailedRecords"),
        F.round(F.avg("failure_rate"), 6).alias("AvgFailureRate"),
    ).orderBy("check_type", "severity")


def recent_issues(log: DataFrame, k: int = 20) -> DataFrame:
    """The k newest failed checks."""
    return (
        log.where("records_failed > 0")
        .orderBy(F.desc("check_timestamp"), "check_name", "table_name")
        .limit(k)
        .select("check_name", "table_name", "severity", "records_failed", "failure_rate", "error_message",
                "check_timestamp")
    )
