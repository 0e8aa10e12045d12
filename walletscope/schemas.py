"""Table and message schemas, as DDL text."""

EVENTS = (
    "event_id string, chain string, address string, lt bigint, tx_hash string, "
    "block_time timestamp, raw_json string, created_at timestamp"
)
CHECKPOINTS = (
    "chain string, address string, provider string, last_lt bigint, last_hash string, "
    "updated_at timestamp"
)
MONITORED_ADDRESSES = (
    "chain string, address string, provider string, asset_id string, balance string, "
    "is_active boolean, discovered_at timestamp, updated_at timestamp"
)
ADDRESS_LEASES = ("lease_key string, owner_id string, expires_at timestamp")
EVENT_MESSAGE = (
    "correlation_id string, event_id string, chain string, provider string, address string, "
    "cursor struct<primary: bigint, secondary: string>, occurred_at timestamp, raw_json string"
)
MESSAGE_FIELDS = ["correlation_id", "event_id", "chain", "provider", "address", "cursor",
                  "occurred_at", "raw_json"]
METRIC_SAMPLES = ("metric string, labels map<string, string>, ts timestamp, value double")

WALLET = ["chain", "address", "provider"]
MONITORED_KEY = ["chain", "address", "provider", "asset_id"]
