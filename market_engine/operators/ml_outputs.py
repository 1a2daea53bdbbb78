"""Model outputs: predictions table, metrics row, run record, feature importance (M-10..M-13)."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from market_engine.functions.columns import instant_to_utc_ntz

from market_engine.operators import ml
from market_engine.schemas import MODEL_METRICS, PREDICTIONS
from market_engine.session import materialise_frame


def _at(ts: str | None):
    # job-supplied timestamp for reproducible reruns; defaults to the query's current time (UTC)
    return F.lit(ts).cast("timestamp_ntz") if ts else instant_to_utc_ntz(F.current_timestamp())


def predictions(scored: DataFrame, model_version: str, predicted_at: str | None = None) -> DataFrame:
    """M-10: one row per test hour and hub. Keys travel with the rows, so nothing is re-joined.

    ``actual_price_spike_flag`` holds the next-hour flag the model predicts.
    """
    out = scored.select(
        "hour_utc", "trading_hub",
        F.col(ml.TARGET).cast("int").alias("actual_price_spike_flag"),
        F.col("predicted_price_spike_flag").cast("int").alias("predicted_price_spike_flag"),
        F.col("predicted_spike_probability").cast("double").alias("predicted_spike_probability"),
        "lmp_avg", "demand_mwh",
        F.lit(model_version).alias("model_version"),
        _at(predicted_at).alias("predicted_at"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in PREDICTIONS.fields])


def model_metrics(scored: DataFrame, train: DataFrame, model_version: str, trained_at: str | None = None) -> DataFrame:
    """M-11: one metrics row (D-14 counts, D-15 AUC)."""
    m = ml.binary_metrics(scored)
    auc = ml.roc_auc(scored)
    n_train = train.count()
    row = m.withColumn("roc_auc", auc.select("roc_auc").scalar())
    out = row.select(
        F.lit(model_version).alias("model_version"),
        F.lit(n_train).cast("bigint").alias("training_row_count"),
        F.col("n").cast("bigint").alias("test_row_count"),
        "accuracy", "precision_score", "recall_score", "f1_score", "roc_auc",
        _at(trained_at).alias("trained_at"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in MODEL_METRICS.fields])


def save_run(spark: SparkSession, model: ml.TrainedModel, metrics: DataFrame, path: str,
             params: dict | None = None) -> str:
    """M-12: run record under ``path``: fitted pipeline, parameters (JSON) and metrics (Parquet)."""
    model.pipeline.write().overwrite().save(f"{path}/model")
    record = {"model_type": type(model.pipeline.stages[-1]).__name__, "numeric_features": model.numeric,
              "categorical_features": model.categorical, "reg_param": model.reg_param, **(params or {})}
    spark.createDataFrame([(json.dumps(record),)], "params string").write.mode("overwrite").json(f"{path}/params")
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")
    return path


def feature_importance(model: ml.TrainedModel, test: DataFrame, features: Sequence[str] | None = None,
                       seed: int = 7) -> DataFrame:
    """M-13 of a fitted model, see ``permutation_importance``."""
    return permutation_importance(lambda df: ml.score(model, df), test, features or model.numeric, seed)


def permutation_importance(score: Callable[[DataFrame], DataFrame], test: DataFrame, features: Sequence[str], seed: int = 7) -> DataFrame:
    """M-13: AUC drop when one feature's values are permuted across test rows; one job.

    Each test row is paired with a donor row (the row holding the same rank under a second hash
    order: distributed row numbers + one equi join). Every feature gets its own copy of the test
    set in which only that feature takes the donor's value (one ``explode``, no union), the
    copies are scored together and one AUC per feature comes from a grouped AUC.
    """
    from market_engine.operators.ranking import distributed_row_number, hex_bucket
    feats = list(features)
    keyed = distributed_row_number(test.withColumn("_h1", ml.split_hash(seed)), [], hex_bucket(F.col("_h1")),
                                   [F.col("_h1")], "_r1", broadcast_offsets=True)
    keyed = distributed_row_number(keyed.withColumn("_h2", ml.split_hash(seed + 1)), [], hex_bucket(F.col("_h2")),
                                   [F.col("_h2")], "_r2", broadcast_offsets=True)
    keyed = materialise_frame(keyed)                 # read by both sides of the pairing join
    donor = keyed.select(F.col("_r2").alias("_r1"), *[F.col(f).alias(f"_d_{f}") for f in feats])
    paired = keyed.join(donor, "_r1").withColumn("feature", F.explode(F.array(*[F.lit(f) for f in feats])))
    permuted = paired.withColumns({f: F.when(F.col("feature") == f, F.col(f"_d_{f}")).otherwise(F.col(f))
                                   for f in feats})
    permuted = permuted.drop("_h1", "_h2", "_r1", "_r2", *[f"_d_{f}" for f in feats])
    base = ml.roc_auc(score(test)).select("roc_auc").scalar()
    per = ml.roc_auc(score(permuted), by=["feature"])
    return per.select("feature", base.alias("base_auc"), F.col("roc_auc").alias("permuted_auc"),
                      (base - F.col("roc_auc")).alias("importance"))


def scaled_coefficients(model: ml.TrainedModel, spark: SparkSession) -> DataFrame:
    """M-13, linear form: the coefficients of the standardised inputs, rows (feature, coefficient, size), largest size
    first for a reader who sorts; one row a model input."""
    from pyspark.ml.feature import StringIndexerModel
    last = model.pipeline.stages[-1]
    names = list(model.numeric)
    for stage in model.pipeline.stages:
        if isinstance(stage, StringIndexerModel):
            names += [f"{stage.getInputCol()}={level}" for level in stage.labels]
    rows = [(n, float(c), abs(float(c))) for n, c in zip(names, last.coefficients.toArray())]
    return spark.createDataFrame(rows, "feature string, coefficient double, size double")
