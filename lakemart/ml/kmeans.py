"""Customer segments by K-means, and their description."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart import config

# --- fixed values: segment names by mean recency, frequency and monetary value ---
# (name, recency below, recency above, frequency above, frequency below, monetary above)
SEGMENT_NAMES = [
    ("Champions", 30, None, 10, None, 1000),
    ("Loyal Customers", 60, None, 5, None, 500),
    ("Potential Loyalists", 30, None, None, 5, 500),
    ("At Risk", None, 90, 5, None, 500),
]
NOISE_NAME = "Noise/Outliers"


def train(features: DataFrame, k: int = 5, restarts: int = 10, seed: int = 42,
          columns: list[str] | None = None) -> PipelineModel:
    """Scale, then the cheapest of several K-means runs.

    Pass features from a written table: every run scans them. The runs are
    independent and share the cluster. Dividing by the
    sample or the population deviation scales all columns alike, which leaves
    the clusters unchanged.
    """
    columns = columns or config.SEGMENT_FEATURES
    prepare = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]).fit(features)
    scaled = prepare.transform(features).select("features").persist()
    try:
        with ThreadPoolExecutor(4) as pool:
            models = list(pool.map(
                lambda i: KMeans(k=k, seed=seed + i, predictionCol="Segment").fit(scaled), range(restarts)
            ))
    finally:
        scaled.unpersist()
    best = min(models, key=lambda m: m.summary.trainingCost)
    return PipelineModel(stages=[*prepare.stages, best])


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    return model.transform(features).drop("raw_features", "features")


def _rule(low_r, high_r, low_f, high_f, low_m) -> Column:
    r, f, m = F.col("Avg_Recency"), F.col("Avg_Frequency"), F.col("Avg_Monetary")
    tests = [
        r < low_r if low_r is not None else None,
        r > high_r if high_r is not None else None,
        f > low_f if low_f is not None else None,
        f < high_f if high_f is not None else None,
        m > low_m,
    ]
    kept = [t for t in tests if t is not None]
    out = kept[0]
    for t in kept[1:]:
        out = out & t
    return out


def segment_stats(segmented: DataFrame, segment: str = "Segment", names: list | None = None) -> DataFrame:
    """Mean features, size and name of every segment (-1 is noise). Means come from exact sums."""
    def mean(c: str, out: str) -> Column:
        return F.round(F.sum(F.col(c).cast("decimal(28,6)")) / F.count(c), 2).cast("double").alias(out)

    stats = segmented.groupBy(F.col(segment).alias("Segment")).agg(
        mean("Recency", "Avg_Recency"), mean("Frequency", "Avg_Frequency"), mean("Monetary", "Avg_Monetary"),
        mean("AvgOrderSize", "Avg_OrderSize"), mean("RevenuePerOrder", "Avg_RevenuePerOrder"),
        mean("CustomerLifespan", "Avg_Lifespan"), F.count("CustomerKey").alias("Customer_Count"),
    )
    title = F.concat(F.lit("Segment "), F.col("Segment").cast("string"))
    for name, *limits in reversed(names or SEGMENT_NAMES):
        title = F.when(_rule(*limits), name).otherwise(title)
    return stats.withColumn("Description", F.when(F.col("Segment") == -1, NOISE_NAME).otherwise(title))
