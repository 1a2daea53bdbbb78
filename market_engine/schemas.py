"""Table schemas (raw landing tables, mart, ML outputs)."""

from pyspark.sql import types as T

NTZ = T.TimestampNTZType()
D = T.DoubleType()
S = T.StringType()

LMP_5MIN = T.StructType([
    T.StructField("interval_start", NTZ, False),
    T.StructField("interval_end", NTZ, False),
    T.StructField("trading_hub", S, False),
    T.StructField("lmp", D, True),
    T.StructField("energy_component", D, True),
    T.StructField("congestion_component", D, True),
    T.StructField("loss_component", D, True),
    T.StructField("market", S, True),
    T.StructField("source_system", S, True),
    T.StructField("loaded_at", NTZ, True),
])

OPS_HOURLY = T.StructType([
    T.StructField("period", NTZ, False),
    T.StructField("balancing_authority", S, False),
    T.StructField("demand_mwh", D, True),
    T.StructField("demand_forecast_mwh", D, True),
    T.StructField("net_generation_mwh", D, True),
    T.StructField("interchange_mwh", D, True),
    T.StructField("source_system", S, True),
    T.StructField("loaded_at", NTZ, True),
])

# One operations API page: {"response": {"total": .., "data": [..]}} or {"error": ..}.
OPS_PAGE = T.StructType([
    T.StructField("error", S, True),
    T.StructField("response", T.StructType([
        T.StructField("total", S, True),
        T.StructField("data", T.ArrayType(T.StructType([
            T.StructField("period", S, True),
            T.StructField("respondent", S, True),
            T.StructField("type", S, True),
            T.StructField("type-name", S, True),
            T.StructField("value", S, True),
        ])), True),
    ]), True),
])

PREDICTIONS = T.StructType([
    T.StructField("hour_utc", NTZ, False),
    T.StructField("trading_hub", S, False),
    # holds the NEXT-hour flag (the training target), as written by the reference job
    T.StructField("actual_price_spike_flag", T.IntegerType(), True),
    T.StructField("predicted_price_spike_flag", T.IntegerType(), True),
    T.StructField("predicted_spike_probability", D, True),
    T.StructField("lmp_avg", D, True),
    T.StructField("demand_mwh", D, True),
    T.StructField("model_version", S, False),
    T.StructField("predicted_at", NTZ, True),
])

MODEL_METRICS = T.StructType([
    T.StructField("model_version", S, False),
    T.StructField("training_row_count", T.LongType(), True),
    T.StructField("test_row_count", T.LongType(), True),
    T.StructField("accuracy", D, True),
    T.StructField("precision_score", D, True),
    T.StructField("recall_score", D, True),
    T.StructField("f1_score", D, True),
    T.StructField("roc_auc", D, True),
    T.StructField("trained_at", NTZ, True),
])
