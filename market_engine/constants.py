"""Domain constants. Fixed values that must equal the reference's for equal results."""

# --- fixed values (reference domain codes) ---------------------------------------
# trading hub -> pricing node id
HUB_NODES = {"NP15": "TH_NP15_GEN-APND", "SP15": "TH_SP15_GEN-APND", "ZP26": "TH_ZP26_GEN-APND"}
# price item code -> column
PRICE_ITEMS = {"LMP": "lmp", "MCE": "energy_component", "MCC": "congestion_component", "MCL": "loss_component"}
# operations type code -> column
OPS_CODES = {"D": "demand_mwh", "DF": "demand_forecast_mwh", "NG": "net_generation_mwh", "TI": "interchange_mwh"}
MARKETS = ("RTM", "DAM")
SEVERITIES = ("NORMAL", "ELEVATED", "SPIKE", "EXTREME")
DEFAULT_BA = "CISO"
DEFAULT_MARKET = "RTM"
INTERVALS_PER_HOUR = 12
DEFAULT_LAGS = (1, 24, 168)
# price CSV header candidates, first present wins
PRICE_CSV_CANDIDATES = {
    "item": ["LMP_TYPE", "DATA_ITEM"],
    "value": ["MW", "VALUE"],
    "start": ["INTERVALSTARTTIME_GMT", "INTERVAL_START_GMT", "STARTTIME", "START_TIME"],
    "end": ["INTERVALENDTIME_GMT", "INTERVAL_END_GMT", "ENDTIME", "END_TIME"],
}
OPS_TYPE_CANDIDATES = ["type", "type-name"]
# model feature candidates
NUMERIC_FEATURES = [
    "lmp_avg", "lmp_lag_1h", "lmp_lag_24h", "lmp_lag_168h", "lmp_stddev", "demand_mwh",
    "demand_forecast_mwh", "net_generation_mwh", "interchange_mwh", "hour_of_day", "day_of_week", "is_weekend",
]
CATEGORICAL_FEATURES = ["trading_hub"]
MIN_TRAINING_ROWS = 50
MAX_ITER = 1000
# lineage values stamped on loaded rows, and the model version prefix
PRICES_SOURCE_SYSTEM = "caiso_oasis"
OPS_SOURCE_SYSTEM = "eia_api"
MODEL_VERSION_PREFIX = "price_spike_logreg"
# ---------------------------------------------------------------------------------
