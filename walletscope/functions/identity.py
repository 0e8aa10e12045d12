"""Identifiers, cursors and times as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def event_id(chain, address, lt, tx_hash) -> Column:
    """First 16 hex digits of SHA-256 over ``chain:address:lt:hash``; NULL if any part is."""
    sep = F.lit(":")
    text = F.concat(_c(chain), sep, _c(address), sep, _c(lt).cast("string"), sep, _c(tx_hash))
    return F.substring(F.sha2(text, 256), 1, 16)


def event_id_short(chain, lt, tx_hash) -> Column:
    return event_id(chain, F.lit(""), lt, tx_hash)


def cursor_text(primary, secondary) -> Column:
    return F.concat(_c(primary).cast("string"), F.lit(":"), _c(secondary))


def parse_cursor(text) -> Column:
    """``struct<primary, secondary>`` of a strict ``int64:non-blank`` text, else NULL."""
    parts = F.split(_c(text), ":")
    head, tail = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    digits = F.nullif(F.regexp_extract(head, r"^\s*([+-]?[0-9]+)\s*$", 1), F.lit(""))
    primary = digits.try_cast("bigint")
    good = (F.size(parts) == 2) & primary.isNotNull() & tail.rlike(r"\S")
    return F.when(good, F.struct(primary.alias("primary"), tail.alias("secondary")))


def lease_key(chain, provider, address) -> Column:
    return F.concat(_c(chain), F.lit(":"), _c(provider), F.lit(":"), _c(address))


def lease_parts(key) -> Column:
    """Chain, provider, address; an address may itself hold ':' so only two splits."""
    parts = F.split(_c(key), ":", 3)
    names = ("chain", "provider", "address")
    return F.struct(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])


def block_time(unix_seconds) -> Column:
    return F.timestamp_seconds(_c(unix_seconds))


def correlation_id(*candidates) -> Column:
    """The first id at hand (header before body), else a fresh random one of 32 hex digits."""
    return F.coalesce(*[_c(c) for c in candidates], F.replace(F.uuid(), F.lit("-"), F.lit("")))
