"""Per-depth class and confidence from a Spark ML classifier, trained and checked by held-out group."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def train(
    df: DataFrame, features: list[str], label: str = "label", trees: int = 20, depth: int = 6,
    seed: int = 42,
) -> PipelineModel:
    """Trees grow from statistics merged over executors; no data reaches the driver.

    A null curve value is kept as NaN, which the trees send down one side of a split.
    """
    assemble = VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="keep")
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[assemble, forest]).fit(df)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``lithology_code`` and ``confidence``."""
    scored = model.transform(df)
    return scored.withColumns(
        {
            "lithology_code": F.col("prediction").cast("int"),
            "confidence": F.array_max(vector_to_array("probability")),
        }
    ).drop("_features", "rawPrediction", "probability", "prediction")


def held_out_metrics(scored: DataFrame, label: str = "label") -> dict[str, float]:
    """Accuracy and weighted F1 of a scored frame."""
    pairs = scored.select(
        F.col(label).cast("double").alias(label),
        F.col("lithology_code").cast("double").alias("prediction"),
    )
    return {
        name: MulticlassClassificationEvaluator(
            labelCol=label, predictionCol="prediction", metricName=name
        ).evaluate(pairs)
        for name in ("accuracy", "f1")
    }


def save_version(
    model: PipelineModel, root: str, version: str, spark: SparkSession, note: str | None = None
) -> None:
    """Keep a trained pipeline under a version, and its row of the version table.

    The row is written last, so a version that was interrupted is not listed and can be saved again.
    """
    place = os.path.join(root, "models", version)
    model.write().overwrite().save(place)
    features = list(model.stages[0].getInputCols())
    row = [(version, place, features, int(model.stages[1].numClasses), note)]
    spark.createDataFrame(row, "version string, path string, features array<string>, n_classes int, note string").write.mode(
        "overwrite"
    ).parquet(os.path.join(root, "versions", f"of={version}"))


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The version table: ``version, path, features, n_classes, note``."""
    return spark.read.parquet(os.path.join(root, "versions")).drop("of")


def load_versions(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, PipelineModel]:
    """Saved pipelines by version, all or the named ones; a name that was never saved is an error.

    The table has a row per trained model, and models are held by the driver as for any scoring.
    """
    rows = {r["version"]: r["path"] for r in versions(spark, root).select("version", "path").collect()}
    missing = sorted(set(names or ()) - set(rows))
    if missing:
        raise ValueError(f"unknown model version(s): {', '.join(missing)}")
    return {v: PipelineModel.load(rows[v]) for v in (names if names is not None else sorted(rows))}


def score_versions(df: DataFrame, models: dict[str, PipelineModel]) -> DataFrame:
    """One row per row and version, with ``version, lithology_code, confidence`` added.

    The models transform the same rows one after the other, without a shuffle: the input is read once,
    however many versions there are. No versions give no rows.
    """
    if not models:
        none = {"version": "string", "lithology_code": "int", "confidence": "double"}
        return df.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}).limit(0)
    own, said = df.columns, []
    for i, (name, model) in enumerate(models.items()):
        df = score(df, model)
        told = F.struct(F.lit(name).alias("version"), "lithology_code", "confidence").alias(f"_v{i}")
        df = df.select(*own, *said, told)
        said.append(f"_v{i}")
    return df.select(*own, F.inline(F.array(*said)))


def confusion(scored: DataFrame, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """``(*by, label, lithology_code, n)``."""
    return scored.groupBy(*(by or []), F.col(label).cast("int").alias("label"), "lithology_code").agg(
        F.count(F.lit(1)).alias("n")
    )


def held_out_table(scored: DataFrame, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """The same two metrics from one pass over (label, prediction) counts: one row, or one per group."""
    by = by or []
    counts = confusion(scored, label, by).withColumnsRenamed({"label": "l", "lithology_code": "p"})
    per = counts.select(
        *by, F.inline(
            F.array(
                F.struct(
                    F.col("l").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("said"),
                    F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("p").alias("c"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("said"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        )
    ).groupBy(*by, "c").agg(*[F.sum(x).alias(x) for x in ("support", "said", "hit")])
    f1 = F.when(
        F.col("support") + F.col("said") > 0,
        2.0 * F.col("hit") / (F.col("support") + F.col("said")),
    ).otherwise(0.0)
    return per.groupBy(*by).agg(
        F.sum("support").alias("n_test"),
        (F.sum("hit") / F.sum("support")).alias("accuracy"),
        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )
