"""Values that must equal those of the payment-risk system this package replaces."""

# --- fixed values: windows, limits and cut-offs -----------------------------
HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
HISTORY_CAP = 500
STATS_DAYS = 30
MIN_STATS_ROWS = 2
MINUTES_CAP = 10_080
REVIEW_AT = 0.3
BLOCK_AT = 0.7
TOP_K = 5
SPLIT = (0.70, 0.15, 0.15)
MIN_PR_AUC = 0.20
MIN_RECALL_AT_5PCT_FPR = 0.40
MIN_TRAINING_ROWS = 1_000
DRIFT_REFERENCE_ROWS = 5_000
DRIFT_CURRENT_ROWS = 1_000
DRIFT_MIN_ROWS = 100
DRIFT_THRESHOLD = 0.05
PSI_BINS = 10
PSI_FLOOR = 0.0001
PSI_ALARM = 0.1
ERROR_BUDGET = 100

# --- fixed values: model and drift column lists, in model order -------------
MODEL_FEATURES = [
    "amount",
    "amount_zscore",
    "user_avg_amount_30d",
    "user_txn_count_1h",
    "user_txn_count_24h",
    "user_txn_count_7d",
    "user_amount_sum_1h",
    "user_amount_sum_24h",
    "country_change_flag",
    "device_change_flag",
    "unique_countries_24h",
    "unique_merchants_24h",
    "user_merchant_first_time",
    "hour_of_day",
    "day_of_week",
    "is_weekend",
    "is_night",
    "minutes_since_last_txn",
    "channel_encoded",
]

DRIFT_FEATURES = [
    "amount",
    "amount_zscore",
    "user_txn_count_1h",
    "user_txn_count_24h",
    "user_amount_sum_1h",
    "user_amount_sum_24h",
    "unique_countries_24h",
    "unique_merchants_24h",
    "hour_of_day",
    "channel_encoded",
]

# --- fixed values: channel codes --------------------------------------------
CHANNEL_CODES = {"POS": 0, "ECOM": 1, "ATM": 2}

# --- fixed values: allowed words --------------------------------------------
DECISIONS = ["APPROVE", "REVIEW", "BLOCK"]
RESOLUTIONS = ["CONFIRMED_FRAUD", "FALSE_POSITIVE", "PENDING", "ESCALATED"]

# --- fixed values: histogram bucket bounds in seconds -----------------------
SCORING_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.15, 0.2, 0.3, 0.5, 1.0]
DRIFT_CHECK_BUCKETS = [1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0]

# --- fixed values: model parameters -----------------------------------------
CLASSIFIER_PARAMS = {
    "maxIter": 100,
    "maxDepth": 6,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "seed": 42,
}
STOPPING_PATIENCE = 10
FOREST_PARAMS = {"trees": 200, "sample_rows": 256, "contamination": 0.02, "seed": 42}

# --- fixed values: names of the features in explanations --------------------
FEATURE_TEXT = {
    "amount": "Transaction amount",
    "amount_zscore": "Amount compared to user's average",
    "user_avg_amount_30d": "User's typical spending amount",
    "user_txn_count_1h": "Transactions in last hour",
    "user_txn_count_24h": "Transactions in last 24 hours",
    "user_txn_count_7d": "Transactions in last 7 days",
    "user_amount_sum_1h": "Total spent in last hour",
    "user_amount_sum_24h": "Total spent in last 24 hours",
    "country_change_flag": "Country changed from last transaction",
    "device_change_flag": "Device changed from last transaction",
    "unique_countries_24h": "Different countries in 24 hours",
    "unique_merchants_24h": "Different merchants in 24 hours",
    "user_merchant_first_time": "First time at this merchant",
    "hour_of_day": "Hour of transaction",
    "day_of_week": "Day of week",
    "is_weekend": "Weekend transaction",
    "is_night": "Night-time transaction (midnight-6am)",
    "minutes_since_last_txn": "Minutes since last transaction",
    "channel_encoded": "Transaction channel (POS/ECOM/ATM)",
}
