"""Parameters that define the semantics of the engine."""

# Request ranges and chart buckets, in seconds.
RANGES = {
    "1h": 3_600,
    "6h": 21_600,
    "24h": 86_400,
    "7d": 604_800,
    "30d": 2_592_000,
    "90d": 7_776_000,
}
BUCKETS = {"1m": 60, "5m": 300, "1h": 3_600, "1d": 86_400}

# The bucket each range of the history view is drawn at.
DEFAULT_BUCKET = {
    "1h": "1m",
    "6h": "5m",
    "24h": "5m",
    "7d": "1h",
    "30d": "1d",
    "90d": "1d",
}
EDITOR_MAX_RANGE = "7d"

MAX_POINTS = 1_440
MAX_LIMIT = 50

# Days each table is kept; None keeps it for good.
RETENTION_DAYS = {"edits": 7, "edits_errors": 30, "edits_1m": 90, "edits_1d": None}

WINDOW_SECONDS = 5
GRACE_SECONDS = 1.0
MAX_GAP_WINDOWS = 12
HISTORY_WINDOWS = 120
WINDOW_TTL_SECONDS = HISTORY_WINDOWS * WINDOW_SECONDS * 2
STALE_AFTER_SECONDS = 30
COLD_MAX_AGE_SECONDS = 60
TOP_EDITORS = 5
EDITORS_TRACKED = 10_000
TOP_WIKIS_SHOWN = 8

TOPIC = "changes"
TOPIC_PARTITIONS = 6

# Placeholders of the live path.
UNKNOWN = "unknown"
ANONYMOUS = "anonymous"

# lg(nominal entries) of the distinct-editor sketch: exact up to 65,536 editors.
SKETCH_LG = 16

# Histogram bounds, in seconds.
EMIT_DELAY_BOUNDS = (0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 5.0, 10.0, 30.0)

# Fixed values: (lower edge, band) of the lag and emit-delay panels.
LAG_BANDS = ((None, "green"), (1000, "yellow"), (3000, "red"))
DELAY_BANDS = ((None, "green"), (2.5, "yellow"), (5, "red"))
