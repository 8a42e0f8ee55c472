"""Churn prediction with a random forest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.columns import right_closed_bin
from lakemart.functions.ranks import running_total
from lakemart.operators.features import churn_columns

LABEL = "IsChurned"
FOLDS = 5
RISK_BINS = ([0, 0.3, 0.7, 1.0], ["Low", "Medium", "High"])


@dataclass
class ChurnResult:
    model: PipelineModel
    columns: list[str]
    accuracy: float
    cv_scores: list[float]
    confusion: DataFrame

    def importances(self, spark: SparkSession) -> DataFrame:
        weights = self.model.stages[-1].featureImportances.toArray()
        rows = [(c, float(v)) for c, v in zip(self.columns, weights)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))


def with_folds(features: DataFrame, key: str = "CustomerKey", label: str = LABEL, folds: int = FOLDS) -> DataFrame:
    """Number 0..folds-1 per row, each class spread evenly over the folds.

    Rows of a class are ranked in hash order by ranges, so a class that holds
    most of the rows is never sorted in one task.
    """
    hashed = features.withColumn("__h", F.xxhash64(key)).withColumn("__one", F.lit(1).cast("long"))
    ranked = running_total(hashed, "__h", "__one", "__rank", by=[label])
    return ranked.withColumn("fold", (F.col("__rank") % folds).cast("int")).drop("__h", "__one", "__rank")


def with_class_weight(features: DataFrame, label: str = LABEL) -> DataFrame:
    """Weight n / (classes * n_class), so that both classes count alike."""
    counts = {r[label]: r["count"] for r in features.groupBy(label).count().collect()}
    total, weight = sum(counts.values()), F.lit(1.0)
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, float(total) / (len(counts) * n)).otherwise(weight)
    return features.withColumn("weight", weight)


def _pipeline(columns: list[str], trees: int, depth: int, seed: int) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        RandomForestClassifier(labelCol=LABEL, featuresCol="features", weightCol="weight", numTrees=trees,
                               maxDepth=depth, seed=seed),
    ])


def _fit(pipeline: Pipeline, data: DataFrame) -> PipelineModel:
    """Fit, and keep the forest without its training summary: the summary holds
    on to the training frame, which would travel with every scoring task."""
    fitted = pipeline.fit(data)
    return PipelineModel(stages=[*fitted.stages[:-1], fitted.stages[-1].copy()])


def _accuracy(scored: DataFrame) -> float:
    return scored.agg(F.avg((F.col(LABEL) == F.col("prediction")).cast("double"))).first()[0]


def train(features: DataFrame, trees: int = 100, depth: int = 10, seed: int = 42, drop_leak: bool = False,
          cross_validate: bool = True) -> ChurnResult:
    """Fit on four of five folds, test on the fifth, and cross-validate over all five."""
    columns = churn_columns(drop_leak)
    data = with_class_weight(with_folds(features)).persist()
    try:
        pipeline = _pipeline(columns, trees, depth, seed)
        model = _fit(pipeline, data.where("fold <> 0"))
        tested = model.transform(data.where("fold = 0")).select(LABEL, "prediction")
        confusion_rows = tested.groupBy(LABEL, "prediction").count().collect()
        hits = sum(r["count"] for r in confusion_rows if r[LABEL] == r["prediction"])
        scores = []
        if cross_validate:
            for i in range(FOLDS):
                fitted = model if i == 0 else _fit(pipeline, data.where(F.col("fold") != i))
                scores.append(_accuracy(fitted.transform(data.where(F.col("fold") == i))))
    finally:
        data.unpersist()
    confusion = features.sparkSession.createDataFrame(
        [(int(r[LABEL]), int(r["prediction"]), int(r["count"])) for r in confusion_rows],
        "label int, prediction int, records bigint",
    )
    total = sum(r["count"] for r in confusion_rows)
    return ChurnResult(model, columns, hits / total if total else 0.0, scores, confusion)


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Churn probability, class and risk band per customer."""
    scored = model.transform(features.withColumn("weight", F.lit(1.0)))
    chance = vector_to_array("probability")[1]
    return scored.withColumn("ChurnProbability", chance).select(
        *features.columns, "ChurnProbability", F.col("prediction").cast("int").alias("PredictedChurn"),
        right_closed_bin(F.col("ChurnProbability"), *RISK_BINS).alias("ChurnRisk"),
    )


def confusion_counts(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("records")
    )


def classification_report(confusion: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, with the overall accuracy."""
    right = F.when(F.col("label") == F.col("prediction"), F.col("records")).otherwise(0)
    by_label = confusion.groupBy("label").agg(F.sum("records").alias("support"), F.sum(right).alias("hits"))
    by_guess = confusion.groupBy(F.col("prediction").alias("label")).agg(F.sum("records").alias("guessed"))
    accuracy = confusion.agg(F.sum(right).cast("double") / F.sum("records")).scalar()
    precision = F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("guessed").cast("double")), F.lit(0.0))
    recall = F.col("hits").cast("double") / F.col("support")
    joined = by_label.join(by_guess, "label", "left").withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.coalesce(
        F.try_divide(2.0 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)
    )
    return joined.select("label", "precision", "recall", f1.alias("f1"), "support", accuracy.alias("accuracy"))


def save(result: ChurnResult, spark: SparkSession, path: str) -> None:
    """The fitted pipeline, its metrics and its confusion counts below one folder."""
    result.model.write().save(f"{path}/model")
    metrics(result, spark).write.parquet(f"{path}/metrics")
    result.confusion.write.parquet(f"{path}/confusion")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model")


def metrics(result: ChurnResult, spark: SparkSession) -> DataFrame:
    """Everything a training says about itself: (metric, name, value)."""
    rows = [("accuracy", "test fold", float(result.accuracy))]
    rows += [("cross_validation", f"fold {i}", float(v)) for i, v in enumerate(result.cv_scores)]
    measured = spark.createDataFrame(rows, "metric string, name string, value double")
    weights = result.importances(spark).select(
        F.lit("importance").alias("metric"), F.col("feature").alias("name"), F.col("importance").alias("value"))
    return measured.unionByName(weights)
