"""Counters and gauges of one collection cycle as sample rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def alerts_fired_total(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("asset_id", "direction").agg(F.count("*").alias("alerts"))


def sample_rows(df: DataFrame, metric: str, labels: dict[str, str], value: str, ts: Column) -> DataFrame:
    """Aggregated rows as samples; ``labels`` maps label name to column."""
    pairs = [p for name, column in labels.items() for p in (F.lit(name), F.col(column))]
    bag = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return df.select(F.lit(metric).alias("metric"), bag.cast("map<string,string>").alias("labels"),
                     ts.alias("ts"), F.col(value).cast("double").alias("value"))


def breaker_state(changes: DataFrame) -> DataFrame:
    """The last recorded state (0 closed, 1 half open, 2 open); closed before any change."""
    return changes.agg(F.coalesce(F.max_by("value", F.struct("ts", "sample_id")), F.lit(0.0)).alias("state"))


def discovery_last_success(monitored: DataFrame) -> DataFrame:
    """Unix time at which a discovery cycle last wrote to the monitored set; no row before the first."""
    last = F.floor(F.unix_micros(F.max("updated_at")) / 1_000_000)
    return monitored.agg(last.alias("last_success")).where("last_success IS NOT NULL")


def metric_snapshot(ts: Column, *, ingested: DataFrame, alerts: DataFrame, lag: DataFrame, stale: DataFrame,
                    dead: DataFrame, wallets: DataFrame, breaker: DataFrame, discovery: DataFrame) -> DataFrame:
    """All metrics of a cycle in one sample table."""
    parts = [
        sample_rows(ingested, "events_ingested_total", {"chain": "chain"}, "events", ts),
        sample_rows(alerts, "alerts_fired_total",
                    {"asset": "asset_id", "direction": "direction"}, "alerts", ts),
        sample_rows(lag, "event_lag_seconds", {"chain": "chain", "address": "address"},
                    "lag_seconds", ts),
        sample_rows(stale, "event_lag_stale_wallets", {"chain": "chain"}, "stale_wallets", ts),
        sample_rows(dead, "dlq_messages", {"queue": "queue"}, "dead_messages", ts),
        sample_rows(wallets, "monitored_addresses", {}, "active_wallets", ts),
        sample_rows(breaker, "circuit_breaker_state", {}, "state", ts),
        sample_rows(discovery, "discovery_last_success_timestamp_seconds", {}, "last_success", ts),
    ]
    return reduce(DataFrame.unionByName, parts)
