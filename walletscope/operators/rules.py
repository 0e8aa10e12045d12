"""Alert rules with hold times, as firing intervals in continuous time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from walletscope import params
from walletscope.plans.hot import DEFAULT, HotRule, hot_keys, null_safe_join
from walletscope.plans.running import running_max
from walletscope.plans.settle import settle

FIRING = ["alert", "severity", "series", "starts_at", "ends_at"]


def _plus(ts: Column, seconds) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(seconds * 1_000_000).cast("bigint"))


def hold_for(samples: DataFrame, condition: Column, hold_seconds: int | str,
             keys: Sequence[str] = ("series",), slice_unit: str = "hour",
             rule: HotRule = DEFAULT) -> DataFrame:
    """Stretches of consecutive samples of a key that meet ``condition`` for the hold time.

    Samples between the same two failing ones form a stretch, so the last failing
    sample before a row names its stretch; a stitched running maximum finds it. A hot key
    is cut by ``slice_unit``, which must hold few enough of its samples for one task.
    ``hold_seconds`` is a number or the name of a key column.
    """
    judged = samples.withColumn("_met", F.coalesce(condition, F.lit(False)))
    miss = F.when(~F.col("_met"), F.struct("ts", "sample_id"))
    named = running_max(judged, list(keys), ["ts", "sample_id"],
                        F.date_trunc(slice_unit, F.col("ts")), miss, "_after", rule=rule)
    hold = (F.col(hold_seconds) if isinstance(hold_seconds, str) else F.lit(hold_seconds)).cast("bigint")
    held = F.unix_micros("last_at") - F.unix_micros("active_at")
    starts = F.timestamp_micros(F.unix_micros("active_at") + hold * 1_000_000)
    return (named.where("_met").groupBy(*keys, "_after")
            .agg(F.min("ts").alias("active_at"), F.max("ts").alias("last_at"),
                 F.count("*").alias("samples"))
            .where(held >= hold * 1_000_000)
            .select(*keys, "active_at", starts.alias("starts_at"), F.col("last_at").alias("ends_at"),
                    "samples"))


class SampledRule(NamedTuple):
    """A rule over the samples of one metric; ``condition`` builds the test when it is used."""

    alert: str
    severity: str
    metric: str
    condition: Callable[[], Column]
    hold_seconds: int


def _discovery_age() -> Column:
    return F.unix_micros("ts") / F.lit(1e6) - F.col("value")


DLQ = SampledRule("dlq_message", "critical", "dlq_messages", lambda: F.col("value") > 0, 0)
BREAKER_OPEN = SampledRule("circuit_breaker_open", "critical", "circuit_breaker_state",
                           lambda: F.col("value") == 2, 0)
DISCOVERY_FAILED = SampledRule(
    "discovery_failed", "warning", "discovery_last_success_timestamp_seconds",
    lambda: _discovery_age() > params.DISCOVERY_ALERT_SECONDS, params.DISCOVERY_ALERT_HOLD_SECONDS)
SAMPLED_RULES = (DLQ, BREAKER_OPEN, DISCOVERY_FAILED)


def sampled_rules(samples: DataFrame, rules: Sequence[SampledRule] = SAMPLED_RULES,
                  hot: HotRule = DEFAULT) -> DataFrame:
    """Firing intervals of all given rules in one pass over the samples."""
    tests = [F.when(F.col("metric") == r.metric, F.struct(
        F.lit(r.alert).alias("alert"), F.lit(r.severity).alias("severity"),
        F.lit(r.hold_seconds).alias("hold"), F.coalesce(r.condition(), F.lit(False)).alias("met")))
        for r in rules]
    rows = (samples.where(F.col("metric").isin([r.metric for r in rules]))
            .select("series", "ts", "sample_id", F.explode(F.array_compact(F.array(*tests))).alias("_rule"))
            .select("series", "ts", "sample_id", "_rule.*"))
    return hold_for(rows, F.col("met"), "hold", ["alert", "severity", "hold", "series"],
                    rule=hot).select(*FIRING)


def _quiet(rows: DataFrame, keys: list[str], ts: str, quiet_seconds: int, as_of: Column) -> DataFrame:
    """Intervals in which a key has been quiet for longer than ``quiet_seconds``.

    A gap that long cannot lie inside a time bucket of that width, so the first
    and last row of each bucket are enough. The ordered window then sees at most
    one row per key and bucket, however many rows a key has.
    """
    bucket = F.floor(F.unix_micros(ts) / (quiet_seconds * 1_000_000))
    ends = (rows.groupBy(*keys, bucket.alias("_bucket"))
            .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last")))
    following = F.lead("_first").over(Window.partitionBy(*keys).orderBy("_bucket"))
    return (ends.withColumn("ends_at", F.coalesce(following, as_of))
            .withColumn("starts_at", _plus(F.col("_last"), quiet_seconds))
            .where(F.col("ends_at") > F.col("starts_at")).drop("_bucket", "_first", "_last"))


def rule_ingestion_stalled(events: DataFrame, as_of: Column) -> DataFrame:
    """No event of a chain within the window, for the hold time; starts after its first event."""
    quiet = params.STALL_WINDOW_SECONDS + params.STALL_HOLD_SECONDS
    return (_quiet(events, ["chain"], "block_time", quiet, as_of)
            .select(F.lit("ingestion_stalled").alias("alert"), F.lit("warning").alias("severity"),
                    F.concat(F.lit("chain="), F.col("chain")).alias("series"), "starts_at", "ends_at"))


def rule_lag_high(advances: DataFrame, as_of: Column) -> DataFrame:
    """No checkpoint advance of a wallet for longer than the lag limit and hold time."""
    quiet = params.LAG_ALERT_SECONDS + params.LAG_ALERT_HOLD_SECONDS
    series = F.concat(F.lit("address="), F.col("address"), F.lit(",chain="), F.col("chain"))
    return (_quiet(advances, ["chain", "address"], "arrived_at", quiet, as_of)
            .select(F.lit("event_lag_high").alias("alert"), F.lit("warning").alias("severity"),
                    series.alias("series"), "starts_at", "ends_at"))


def _local_islands(firing: DataFrame, keys: Sequence[str], rule: HotRule) -> DataFrame:
    """Intervals merged with those of the same key, hour of start and bucket.

    Merging is associative, so parts may be merged first. An hour of a key is cut into a
    bucket per ``rule.rows`` of its intervals, so one that many series share fills no task.
    """
    hour = F.date_trunc("hour", "starts_at")
    part = [*keys, "_hour"]
    rows = firing.select(*keys, "starts_at", "ends_at", hour.alias("_hour"))
    full = hot_keys(rows, part, rule, nulls=True)
    bucket = F.coalesce(F.pmod(F.xxhash64("starts_at", "ends_at"), F.ceil(F.col("_rows") / max(rule.rows, 1)).cast("bigint")), F.lit(0))
    cut = null_safe_join(rows, full, part, "left").withColumn("_bucket", bucket)
    order = Window.partitionBy(*part, "_bucket").orderBy("starts_at", "ends_at")
    until = F.max("ends_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(until.isNull() | (F.col("starts_at") > until), 1).otherwise(0)
    numbered = (cut.repartition(*part, "_bucket").withColumn("_opens", opens)
                .withColumn("_island", F.sum("_opens").over(order)))
    return (numbered.groupBy(*part, "_bucket", "_island")
            .agg(F.min("starts_at").alias("starts_at"), F.max("ends_at").alias("ends_at"))
            .select(*keys, "starts_at", "ends_at"))


def merge_intervals(firing: DataFrame, keys: list[str], slice_unit: str = "hour",
                    rule: HotRule = DEFAULT) -> DataFrame:
    """Union of overlapping or touching intervals per key.

    Parts of a key are merged first and written; then the islands of the parts. An interval
    opens an island where it starts after all earlier ones have ended, and where they ended
    is the end of the island before. The last window sees the islands of a key only: they
    are disjoint in time, so their number is bounded by the time covered.
    """
    parts = settle(_local_islands(firing, keys, rule), "islands")
    covered = running_max(parts, keys, ["starts_at", "ends_at"], F.date_trunc(slice_unit, F.col("starts_at")),
                          F.col("ends_at"), "_until", rule=rule)
    opening = covered.where(F.col("_until").isNull() | (F.col("starts_at") > F.col("_until")))
    last = parts.groupBy(*keys).agg(F.max("ends_at").alias("_last"))
    following = F.lead("_until").over(Window.partitionBy(*keys).orderBy("starts_at"))
    return (null_safe_join(opening.withColumn("_next", following), last, keys, "left")
            .select(*keys, "starts_at", F.coalesce("_next", "_last").alias("ends_at")))


def notification_schedule(firing: DataFrame, wait_seconds: int = params.GROUP_WAIT_SECONDS,
                          repeats: dict = params.REPEAT_SECONDS) -> DataFrame:
    """Send times per alert name: after the group wait, then at the repeat interval."""
    def seconds(name: str) -> Column:
        return F.lit(repeats[name] * 1_000_000).cast("bigint")

    severity = F.col("severity")
    receiver = F.when(severity.isin("critical", "warning"), severity).otherwise("default")
    repeat = (F.when(severity == "critical", seconds("critical"))
              .when(severity == "warning", seconds("warning")).otherwise(seconds("default")))
    begin = F.unix_micros("starts_at") + F.lit(wait_seconds * 1_000_000).cast("bigint")
    end = F.unix_micros("ends_at")
    sends = F.when(begin <= end, F.sequence(begin, end, repeat))
    return (merge_intervals(firing, ["alert", "severity"])
            .select("alert", "severity", receiver.alias("receiver"), "starts_at",
                    F.explode(sends).alias("_at"))
            .withColumn("sent_at", F.timestamp_micros("_at")).drop("_at"))
