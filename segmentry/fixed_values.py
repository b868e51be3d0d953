"""Fixed values. They decide results, so they are stated here once, as they are.

Word lists, location ids, hours, names and limits below are part of the definition of the
features; changing one changes what a query returns.
"""

# Trips -------------------------------------------------------------------------------------
AIRPORT_LOCATION_IDS = [132, 138]
WEEKEND_DAYS = [5, 6]  # 0 = Monday
RUSH_HOURS = [7, 8, 9, 16, 17, 18, 19]
MAX_SPEED_MPH = 100
MAX_FARE_PER_MILE = 50
MAX_TIP_RATE = 2
MIN_FARE_DISTANCE = 0.1
MAX_TRIP_MINUTES = 240
MAX_TRIP_MILES = 200
PASSENGER_RANGE = (1, 8)
REQUIRED_TRIP_COLUMNS = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "PULocationID",
    "DOLocationID",
]
MIN_MONTH_ROWS = 100_000

# Reviews -----------------------------------------------------------------------------------
POSITIVE_WORDS = ["great", "excellent", "amazing", "love", "perfect", "awesome", "fantastic"]
NEGATIVE_WORDS = ["terrible", "awful", "horrible", "worst", "broken", "defective", "useless"]
REVIEW_COLUMN_NAMES = {
    "review_id": "id",
    "review_body": "text",
    "star_rating": "rating",
    "product_id": "product_id",
    "customer_id": "customer_id",
    "review_date": "timestamp",
}
MIN_REVIEW_CHARS = 20
DEFAULT_RATING = 3
POSITIVE_RATING = 4
NEGATIVE_RATING = 2

# Text cleaning -----------------------------------------------------------------------------
HTML_TAG = r"<[^>]+>"
MIN_CLEAN_CHARS = 10
MAX_TOKENS = 512
CHARS_PER_TOKEN = 6

# Requests ----------------------------------------------------------------------------------
REQUEST_TEXT_RANGE = (1, 10_000)

# Vectors -----------------------------------------------------------------------------------
EMBEDDING_DIM = 384
EMBEDDING_BATCH = 512
DEFAULT_TOP_K = 10
ANN_CELLS = 100
LEAST_RECALL = 0.9

# Segments ----------------------------------------------------------------------------------
SEGMENT_NAMES = {
    0: "price_sensitive_shoppers",
    1: "brand_loyal_customers",
    2: "high_value_frequent_buyers",
    3: "occasional_reviewers",
    4: "complaint_prone_users",
    5: "enthusiast_early_adopters",
    6: "gift_buyers",
    7: "bargain_hunters",
}
NOISE = -1
N_SEGMENTS = 8
REDUCED_DIM = 50
SEED = 42
KMEANS_STARTS = 10
KMEANS_MAX_ITER = 300
MIN_CLUSTER_SIZE = 50
MIN_SAMPLES = 10

# Drift and gates ---------------------------------------------------------------------------
CENTROID_DRIFT_LIMIT = 0.15
SIZE_DIVERGENCE_LIMIT = 0.10
DRIFT_EPSILON = 1e-9
METRIC_GAIN = 0.02

# Alerts ------------------------------------------------------------------------------------
ERROR_RATE_LIMIT = 0.01
P99_LIMIT_SECONDS = 0.5
ALERT_WINDOW_MINUTES = 5
ALERT_HOLD_MINUTES = 3
STALLED_DAYS = 3
