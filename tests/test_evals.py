from __future__ import annotations

import math

from pyspark.sql import functions as F

from stratalog.config import EvalConfig, SkewConfig
from stratalog.operators import evals

# published loss table: step, train, validation
LOSSES = [
    (250, 1.559, 1.605), (500, 1.420, 1.574), (750, 1.231, 1.566), (1000, 1.141, 1.563),
    (1250, 1.140, 1.560), (1500, 1.012, 1.576), (1750, 1.053, 1.574), (2000, 1.066, 1.574),
]
LOG = "run string, step long, loss double, eval_loss double"


def log(spark, extra=()):
    rows = [("r", s, t, None) for s, t, _ in LOSSES] + [("r", s, None, v) for s, _, v in LOSSES]
    return spark.createDataFrame([*rows, *extra], LOG)


def test_golden_run(spark):
    best = evals.best_eval(log(spark)).first()
    assert (best["best_eval_loss"], best["best_step"]) == (1.560, 1250)
    for skew in (SkewConfig(), SkewConfig(max_rows=2)):
        stop = evals.early_stop(log(spark), skew=skew).first()
        assert (stop["n_evals"], stop["stop_step"]) == (8, 2000)
    assert evals.early_stop(log(spark), EvalConfig(patience=4)).first()["stop_step"] is None


def test_equal_loss_is_no_improvement(spark):
    rows = [("e", i, None, 1.0) for i in range(1, 6)]
    got = evals.early_stop(spark.createDataFrame(rows, LOG)).first()
    assert got["stop_step"] == 4


def test_curves(spark):
    got = evals.loss_curves(log(spark))
    assert {r["metric"]: r["count"] for r in got.groupBy("metric").count().collect()} == {
        "train_loss": 8, "eval_loss": 8,
    }


def test_perplexity(spark):
    df = spark.createDataFrame([("a", 1.812), ("a", float("nan")), ("b", float("nan"))], "g string, loss double")
    got = {r["g"]: r for r in evals.perplexity(df, by=["g"]).collect()}
    assert got["a"]["n_scored"] == 1 and round(got["a"]["perplexity"], 2) == 6.12
    assert got["b"]["n_scored"] == 0 and math.isnan(got["b"]["perplexity"])
    assert evals.perplexity(df).first()["n_scored"] == 1


def test_domain_is_a_substring_match(spark):
    df = spark.createDataFrame(
        [("The SOIL",), ("gastropods",), ("La cuenca",), ("nothing",), (None,)], "question string"
    )
    assert evals.domain_slice(df).count() == 3


def test_review_cuts(spark):
    df = spark.createDataFrame([("q" * 300, "r" * 300, "é" * 300)], "question string, reference string, generated string")
    assert [len(c) for c in evals.review_table(df).first()] == [150, 200, 200]


def test_calibration_and_blind_spots(spark):
    rows = [("a", "a", 0.9), ("a", "b", 0.7), ("b", "b", 0.6999)] + [("Tuff", "a", 0.5)] * 19 + [("Tuff", "Tuff", 0.95)]
    df = spark.createDataFrame(rows, "label string, prediction string, confidence double")
    bands = {r["band"]: (r["n"], r["accuracy"]) for r in evals.calibration(df).collect()}
    assert bands[">=0.9"] == (2, 1.0) and bands["0.7-0.9"] == (1, 0.0) and bands["<0.7"] == (20, 0.05)
    assert [r["label"] for r in evals.blind_spots(df).collect()] == ["Tuff"]


def test_run_metrics(spark):
    rows = spark.createDataFrame([("train",), ("train",), ("val",)], "split string")
    times = log(spark).withColumn("ts", F.timestamp_seconds(F.col("step") * 3))
    results = spark.createDataFrame([(1.0,), (3.0,)], "loss double")
    m = evals.run_metrics(rows, times, results).first()
    assert (m["n_train"], m["n_val"], m["n_test"]) == (2, 1, 0)
    assert m["train_runtime_min"] == 1750 * 3 / 60
    assert m["estimated_credits"] == 1750 * 3 / 3600 * 9
    assert m["best_eval_loss"] == 1.56 and m["test_perplexity"] == math.exp(2.0)
