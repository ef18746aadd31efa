"""Fixed values of the domain: lookup tables, policy constants and label texts."""

# Store -> sales region.
STORE_REGION = {
    "S001": "West",
    "S002": "North",
    "S003": "South",
    "S004": "West",
    "S005": "South",
}

# Store -> ERP plant; any other store gets UNKNOWN_PLANT.
STORE_PLANT = {
    "S001": "PLANT_MUM",
    "S002": "PLANT_DEL",
    "S003": "PLANT_BLR",
    "S004": "PLANT_PUN",
    "S005": "PLANT_CHN",
}
UNKNOWN_PLANT = "UNKNOWN"

# Demand change per 10 degrees above REFERENCE_TEMP; other categories are neutral.
CATEGORY_SENSITIVITY = {
    "Beverages": 0.8,
    "Dairy": -0.3,
    "Snacks": 0.2,
    "Staples": 0.0,
    "Personal Care": 0.3,
    "Ready Meals": -0.4,
    "Household": 0.0,
}

# Store name -> (mean temperature, yearly amplitude).
STORE_CLIMATE = {
    "Mumbai Central": (28.0, 5.0),
    "Delhi North": (25.0, 15.0),
    "Bengaluru South": (22.0, 4.0),
    "Pune East": (26.0, 7.0),
    "Chennai West": (29.0, 4.0),
}
DEFAULT_CLIMATE = (27.0, 8.0)
REFERENCE_TEMP = 27.0
RAINY_WEEK_MM = 20.0

# Inventory policy.
SERVICE_LEVEL_Z = 1.65
ORDERING_COST = 100.0
WEEKS_PER_YEAR = 52
URGENT_ORDER_QTY = 200
STATUS_REORDER = "REORDER"
STATUS_OVERSTOCK = "OVERSTOCK"
STATUS_OK = "OK"

# Feature shape.
LAGS = [1, 2, 3, 4, 8, 12]
ROLL_WINDOWS = [2, 4, 8, 12]
FESTIVAL_MONTHS = [10, 11, 12]
EPSILON = 1e-6

# Weekly columns that feed the models beside the features built from them.
WEEKLY_INPUTS = [
    "year", "month", "quarter", "week_num", "is_promo_week", "is_festival_season", "promo_days", "stockout_days",
    "avg_price",
]

# Settings of the models.
FOREST_SETTINGS = {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 5, "seed": 42}
BOOSTING_SETTINGS = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.07, "subsamplingRate": 0.85, "seed": 42}
BOOSTING_COLUMN_SHARE = "0.8"

# Price scenarios and elasticity labels with their upper bounds.
PRICE_DELTAS = [-0.15, -0.10, -0.05, 0.0, 0.05, 0.10, 0.15]
ELASTICITY_LABELS = [
    (-1.5, "Lower price → Big demand boost (Highly elastic)"),
    (-0.5, "Price reduction moderately increases demand"),
    (0.0, "Price-insensitive — maintain current pricing"),
]
ELASTICITY_OTHER = "Unusual — verify data or check for Giffen behavior"

# Promotion analysis.
PROMO_COST_PER_EVENT = 5000.0
AB_TREATED_SHARE = 0.6

# Product segments from lowest to highest mean demand.
SEGMENT_NAMES = ["Slow Movers", "Stable Core", "High Velocity", "Star Products"]

# Feature sets of the clusterings and of the isolation forest.
STORE_CLUSTER_FEATURES = [
    "avg_weekly_demand", "demand_std", "avg_revenue_per_week",
    "promo_sensitivity", "stockout_rate", "demand_cv",
]
PRODUCT_SEGMENT_FEATURES = ["avg_demand", "demand_std", "demand_cv", "promo_lift", "stockout_rate"]
FOREST_FEATURES = [
    "units_sold", "lag_1w", "roll_mean_4w", "roll_std_4w", "is_festival_season", "is_promo_week",
]

# Open purchase order states.
OPEN_PO_STATUSES = ["AWAITING_APPROVAL", "APPROVED", "IN_TRANSIT"]

SERIES_KEYS = ["store_id", "product_id"]
ITEM_KEYS = ["store_id", "store_name", "product_id", "product_name", "category"]
