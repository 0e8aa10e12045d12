"""Fixed values of the data contract, together in one place.

These constants decide results (thresholds, limits, literal texts), so they are
plain values here and default arguments elsewhere.
"""

# Alerting
NANO_PER_UNIT = 1_000_000_000
ALERT_THRESHOLD = 100
ALERT_ASSET = "TON"
MAX_DECIMAL_UNITS = "79228162514264337593543950335"  # largest 96-bit decimal integer

# Ingest and discovery
CHAIN = "ton"
PROVIDER = "tonapi"
FETCH_LIMIT = 100
TOP_HOLDERS_LIMIT = 100
DISCOVERY_LIMIT = 100

# Monitoring, in seconds
STALE_LAG_SECONDS = 900
LAG_ALERT_SECONDS = 1800
LAG_ALERT_HOLD_SECONDS = 60
STALL_WINDOW_SECONDS = 600
STALL_HOLD_SECONDS = 60
DISCOVERY_ALERT_SECONDS = 7200
DISCOVERY_ALERT_HOLD_SECONDS = 300
GROUP_WAIT_SECONDS = 10
REPEAT_SECONDS = {"critical": 3600, "warning": 14400, "default": 43200}

# Retries
MAX_RETRIES = 3
RETRY_DELAYS_SECONDS = (1, 5, 30)

# Literal texts
UNKNOWN_ADDRESS = "unknown"
OVER_LIMIT_LABEL = "⚠️ Over limit (query shows top 100 anyway)"
WITHIN_LIMIT_LABEL = "✓ OK"
NO_QUALIFYING_TRANSFER = "no_qualifying_transfer"
RAW_JSON_PARSE_ERROR = "raw_json_parse_error"
EVALUATION_ERROR = "evaluation_error"
DECISION_CATEGORY = "whale_decision"
ALERT_LINE_PREFIX = "🐋 WHALE ALERT: "

# Dashboard bands: metric -> (yellow from, red from); None = no such band
HEALTH_BANDS = {
    "dlq_messages": (None, 1),
    "circuit_breaker_state": (1, 2),
    "event_lag_seconds": (1800, 3600),
    "discovery_age_seconds": (3600, 7200),
    "event_lag_stale_wallets": (1, 5),
}
