"""Codes, names and column lists that results depend on."""

# Event codes by level; every other code, and a missing one, is level 3.
LEVEL_1_EVENTS = ["AP", "ATC", "CO"]
LEVEL_2_EVENTS = ["VC", "VP", "VI", "SER"]

# Events whose preceding gap counts as browsing time.
BROWSING_EVENTS = ["SCR", "SER", "HP"]

# Model inputs.
CATEGORICAL_COLUMNS = ["payment_method", "age_bin"]
NUMERIC_COLUMNS = [
    "account_age", "promo_code_used", "total_amount", "purchases_count", "L1_ratio", "total_browsing_time",
]
LABEL_COLUMN = "is_fraud"
SEED = 42
NON_FRAUD_FRACTION = 0.2
TRAIN_TEST_SPLIT = [0.8, 0.2]

# Columns of the served table and of the map.
SERVED_COLUMNS = [
    "transaction_id", "payment_method", "total_amount", "L1_ratio", "clear_payment", "purchases_count",
    "shipment_location_lat", "shipment_location_long", "city", "is_fraud", "prediction",
]
MAP_COLUMNS = ["shipment_location_lat", "shipment_location_long", "city", "is_fraud"]

# Column order of the full feature table.
FEATURE_COLUMNS = [
    "session_id", "transaction_id", "customer_id", "created_at", "product_metadata", "payment_method",
    "payment_status", "promo_amount", "promo_code", "shipment_fee", "shipment_location_lat",
    "shipment_location_long", "total_amount", "clear_payment", "L1_count", "L2_count", "L3_count", "L1_ratio",
    "L2_ratio", "geolocation", "start_time", "finish_time", "midpoint_time", "hour", "time_of_day", "age",
    "first_join_year", "gender", "first_join_date", "purchases_count", "is_fraud", "account_age", "age_bin",
    "promo_code_used", "total_browsing_time",
]

# Display names and colours of the two classes.
LABEL_NAMES = {0: "Non-Fraud", 1: "Fraud"}
FRAUD_COLOR = [255, 0, 0]
CLEAN_COLOR = [0, 0, 255]

HISTOGRAM_BINS = 50
