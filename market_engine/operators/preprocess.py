"""Model inputs as a fitted table: fills, scales and levels learned on training rows only.

``fit`` returns one row per model input: numeric ones with their fill (the training median), mean and scale (population
deviation after the fill; 1 where that is 0), categorical ones with one row per level that the training rows have. The
table can be stored and applied to any later frame: ``apply`` joins it as one row (its size is the number of inputs, not
of rows) and builds the input vector in the order of ``place``. A level that was not seen in training has no place, so
its row gets zeros; a NULL level is 'UNKNOWN'.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from market_engine.operators.ml import medians

UNKNOWN = "UNKNOWN"
SCHEMA = "place int, feature string, level string, fill double, mean double, scale double"


def fit(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """The fitted table. A numeric column without any value in training is left out."""
    spark = train.sparkSession
    x = {c: F.col(c).cast("double") for c in numeric}
    fills = medians(train.select(*[v.alias(c) for c, v in x.items()]), list(numeric)) if numeric else None
    rows = spark.createDataFrame([], SCHEMA)
    if numeric:
        filled = train.join(F.broadcast(fills.select(*[F.col(c).alias(f"_f_{c}") for c in numeric])))  # one row
        filled = filled.select(*[F.coalesce(v, F.col(f"_f_{c}")).alias(c) for c, v in x.items()], *[f"_f_{c}" for c in numeric])
        one = filled.agg(*[f(c).alias(f"{n}{c}") for c in numeric for n, f in (("_m_", F.avg), ("_s_", F.stddev_pop))],
                         *[F.max(f"_f_{c}").alias(f"_f_{c}") for c in numeric])
        cells = [F.struct(F.lit(i).alias("place"), F.lit(c).alias("feature"), F.lit(None).cast("string").alias("level"), F.col(f"_f_{c}").alias("fill"),
                          F.col(f"_m_{c}").alias("mean"), F.coalesce(F.nullif(F.col(f"_s_{c}"), F.lit(0.0)), F.lit(1.0)).alias("scale"))
                 for i, c in enumerate(numeric)]
        rows = one.select(F.explode(F.array(*cells)).alias("r")).select("r.*").filter("fill is not null")
    for j, c in enumerate(categorical):
        level = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
        # few levels in one sorted array: the inputs of a model are a bounded set
        levels = train.select(level.alias("level")).distinct().agg(F.sort_array(F.collect_list("level")).alias("l")).select(F.posexplode("l").alias("i", "level"))
        rows = rows.unionByName(levels.select(
            (F.lit(len(numeric) + 1_000_000 * j) + F.col("i")).cast("int").alias("place"), F.lit(c).alias("feature"), "level",
            *[F.lit(None).cast("double").alias(n) for n in ("fill", "mean", "scale")]))
    return rows


def apply(df: DataFrame, fitted: DataFrame, weights: Mapping[tuple[str, str | None], float] | None = None, name: str = "inputs") -> DataFrame:
    """``df`` with its input vector as array ``name``; with ``weights`` per (feature, level) also their sum product ``margin``."""
    numeric = [r.feature for r in fitted.filter("level is null").select("feature").collect()]  # names of model inputs
    categorical = [r.feature for r in fitted.filter("level is not null").select("feature").distinct().collect()]
    w = F.lit(0.0)
    for (feature, level), x in (weights or {}).items():
        w = F.when((F.col("feature") == feature) & F.col("level").eqNullSafe(F.lit(level)), F.lit(float(x))).otherwise(w)
    model = fitted.withColumn("weight", w).agg(F.sort_array(F.collect_list(F.struct("place", "feature", "level", "fill", "mean", "scale", "weight"))).alias("_model"))
    value = F.create_map(*[y for c in numeric for y in (F.lit(c), F.col(f"`{c}`").cast("double"))]) if numeric else F.lit(None).cast("map<string,double>")
    level = F.create_map(*[y for c in categorical for y in (F.lit(c), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(UNKNOWN)))]
                         ) if categorical else F.lit(None).cast("map<string,string>")
    out = df.withColumns({"_value": value, "_level": level}).join(F.broadcast(model))
    one = lambda r: F.when(r["level"].isNull(), (F.coalesce(F.col("_value")[r["feature"]], r["fill"]) - r["mean"]) / r["scale"]
                           ).otherwise((F.col("_level")[r["feature"]] == r["level"]).cast("double"))
    out = out.withColumn(name, F.transform("_model", one))
    if weights is not None:
        out = out.withColumn("margin", F.aggregate(F.zip_with(name, "_model", lambda x, r: x * r["weight"]), F.lit(0.0), lambda a, x: a + x))
    return out.drop("_value", "_level", "_model")


def linear_probability(df: DataFrame, fitted: DataFrame, weights: Mapping[tuple[str, str | None], float], intercept: float = 0.0,
                       name: str = "predicted_spike_probability") -> DataFrame:
    """M-9 with given coefficients: the logistic probability of the weighted inputs."""
    z = F.col("margin") + F.lit(float(intercept))
    return apply(df, fitted, weights).withColumn(name, 1 / (1 + F.exp(-z))).drop("margin")
