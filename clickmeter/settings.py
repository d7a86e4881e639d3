"""Values shared by every pipeline."""

# These must be exactly so for results to agree.
ISO_SECOND = "yyyy-MM-dd'T'HH:mm:ss'Z'"
BUCKET_PATTERN = r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:00Z\z"
DATE_TIME_PATTERN = r"\A\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})\z"
BLANK_CHARS = "\0\t\n\v\f\r "
GRANULARITIES = ("minute", "hour", "day")
STEP_SECONDS = {"minute": 60, "hour": 3600, "day": 86400}
DEFAULT_GRANULARITY = "minute"
MAX_BUCKETS = 1500
IMPRESSION_TTL_SECONDS = 172800
WATERMARK_DELAY = "30 seconds"
WINDOW_LENGTH = "1 minute"
CHECKPOINT_INTERVAL = "60 seconds"
TRIGGER_SECONDS = 5
DEFAULT_SALT = 8
RETENTION_DAYS = 30
METRICS_ERROR_DETAILS = {
    "unauthenticated": "missing bearer token",
    "missing_parameter": "campaign_id is required",
    "bad_granularity": "granularity must be one of minute, hour, day",
    "bad_range": "from/to must be valid ISO8601 with to > from",
    "forbidden": "campaign not owned by caller",
}
BEARER_PREFIX = "Bearer "
SOURCE_STREAM = "stream"
SOURCE_BATCH = "batch"
EVENT_FIELDS = (
    "event_id",
    "impression_id",
    "ad_id",
    "campaign_id",
    "advertiser_id",
    "click_ts",
    "minute_bucket",
    "ingest_ts",
    "user_agent",
)
REQUIRED_EVENT_FIELDS = EVENT_FIELDS[:-1]
DATE_TIME_FIELDS = ("click_ts", "ingest_ts")
NON_EMPTY_EVENT_FIELDS = ("impression_id", "ad_id", "campaign_id", "advertiser_id")

# Choices of this package.
ARRIVAL_DELAY = "48 hours"
AHEAD_TOLERANCE = "5 minutes"
HOT_CLICKS = 100_000
BLOCK_UNITS = 60
BUCKETS_PER_TASK = 250_000
MOST_TASKS = 200
