from walletscope.functions.amounts import canonical_integer, units
from walletscope.functions.identity import (
    block_time,
    correlation_id,
    cursor_text,
    event_id,
    event_id_short,
    lease_key,
    lease_parts,
    parse_cursor,
)
from walletscope.functions.text import plain_amount, sanitize_json, short_address, transfer_text

__all__ = [
    "block_time", "canonical_integer", "correlation_id", "cursor_text", "event_id",
    "event_id_short", "lease_key", "lease_parts", "parse_cursor",
    "plain_amount", "sanitize_json", "short_address", "transfer_text", "units",
]
