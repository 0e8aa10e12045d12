"""Monotone per-wallet checkpoints with conflict detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from walletscope.plans.hot import DEFAULT, HotRule
from walletscope.plans.running import running_max
from walletscope.schemas import WALLET

SLICE_ROWS = 1 << 20  # arrivals per slice of a wallet


def _seeded(arrivals: DataFrame, checkpoints: DataFrame | None, every: bool = False) -> DataFrame:
    """Arrivals with stored checkpoints ahead of them (arrival_seq -1, no event id).

    Only checkpoints of the arrivals' wallets take part, unless ``every`` is set.
    """
    rows = arrivals.select(*WALLET, "lt", "tx_hash", "arrival_seq", "event_id", "arrived_at")
    if checkpoints is None:
        return rows
    if not every:
        checkpoints = checkpoints.join(arrivals.select(*WALLET).distinct(), WALLET, "left_semi")
    old = checkpoints.select(
        *WALLET, F.col("last_lt").alias("lt"), F.col("last_hash").alias("tx_hash"),
        F.lit(-1).cast("bigint").alias("arrival_seq"), F.lit(None).cast("string").alias("event_id"),
        F.col("updated_at").alias("arrived_at"))
    return old.unionByName(rows)


def checkpoint_fold(arrivals: DataFrame, checkpoints: DataFrame | None = None,
                    slice_rows: int = SLICE_ROWS, rule: HotRule = DEFAULT) -> DataFrame:
    """Outcome of every newly inserted event against the checkpoint at its arrival.

    ``advance``: first for the wallet, or lt above the checkpoint. ``conflict``:
    same lt, other hash. ``ignore``: the rest. The checkpoint before a row is the
    largest earlier lt with the hash that arrived first for it, a running maximum
    of ``(lt, -arrival_seq, hash)``. The arrivals are read twice, so hand in a
    written table.
    """
    state = F.struct(F.col("lt"), (-F.col("arrival_seq")).alias("seq"), F.col("tx_hash"))
    seen = running_max(_seeded(arrivals, checkpoints), WALLET, ["arrival_seq"],
                       F.expr(f"arrival_seq div {int(slice_rows)}"), state, "before",
                       rule=rule)
    outcome = (F.when(F.col("before").isNull() | (F.col("lt") > F.col("before.lt")), "advance")
               .when((F.col("lt") == F.col("before.lt"))
                     & (F.col("tx_hash") != F.col("before.tx_hash")), "conflict")
               .otherwise("ignore"))
    return (seen.where(F.col("event_id").isNotNull()).withColumn("outcome", outcome)
            .select(*WALLET, "event_id", "lt", "tx_hash", "arrival_seq", "arrived_at", "outcome"))


def checkpoint_conflicts(fold: DataFrame) -> DataFrame:
    return fold.where(F.col("outcome") == "conflict")


def moved_checkpoints(fold: DataFrame) -> DataFrame:
    """The new checkpoint of each wallet that an event has advanced."""
    top = F.max(F.struct("lt", (-F.col("arrival_seq")).alias("seq"), "tx_hash", "arrived_at")).alias("top")
    return (fold.where(F.col("outcome") == "advance").groupBy(*WALLET).agg(top)
            .select(*WALLET, F.col("top.lt").alias("last_lt"), F.col("top.tx_hash").alias("last_hash"),
                    F.col("top.arrived_at").alias("updated_at")))


def final_checkpoints(arrivals: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """Checkpoint per wallet after all arrivals: one pre-aggregated maximum, no ordered window."""
    top = F.max(F.struct(F.col("lt"), (-F.col("arrival_seq")).alias("seq"), F.col("tx_hash"),
                         F.col("arrived_at"))).alias("top")
    return (_seeded(arrivals, checkpoints, every=True).groupBy(*WALLET).agg(top)
            .select(*WALLET, F.col("top.lt").alias("last_lt"), F.col("top.tx_hash").alias("last_hash"),
                    F.col("top.arrived_at").alias("updated_at")))


def checkpoint_lookup(checkpoints: DataFrame, chain: str, address: str, provider: str) -> DataFrame:
    """The checkpoint of one wallet, or no row."""
    return checkpoints.where((F.col("chain") == chain) & (F.col("address") == address)
                             & (F.col("provider") == provider))
