"""The event handler as set-wise steps: dedupe, checkpoint, evaluate.

Document bodies are shuffled once, by the dedupe. Checkpointing works on narrow
columns, and only the ids of conflicting events (normally few) meet the bodies
again, as an anti join. These ids are broadcast up to ``CONFLICT_IDS`` of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from walletscope import params
from walletscope.operators.alerts import evaluate
from walletscope.operators.checkpoints import checkpoint_conflicts, checkpoint_fold
from walletscope.operators.ingest import first_arrival, new_events
from walletscope.plans.settle import settle

#: Ids of conflicting events that every executor may hold; more are joined as Spark sees fit.
CONFLICT_IDS = 500_000


def judge(fresh: DataFrame, conflicts: DataFrame, threshold=params.ALERT_THRESHOLD) -> DataFrame:
    """Evaluate new events; a conflicting one is stored but never evaluated.

    Hand in ``conflicts`` as a written table: they are counted first, and only if they are many
    the bodies are shuffled to meet them, whatever size Spark would broadcast by itself.
    """
    ids = conflicts.select("event_id")
    kept = fresh.join(F.broadcast(ids) if ids.count() <= CONFLICT_IDS else ids, "event_id", "left_anti")
    return evaluate(kept, threshold).select(
        "event_id", "chain", "address", "provider", "correlation_id", "status", "hits")


def event_results(outcomes: DataFrame, judged: DataFrame) -> DataFrame:
    """One line per new event: outcome, status, number of alerts and their total amount."""
    total = F.aggregate("hits", F.lit(0).cast("decimal(38,9)"),
                        lambda acc, h: (acc + h["amount"]).cast("decimal(38,9)"))
    per_event = judged.select("event_id", "status", F.size("hits").alias("alerts"),
                              total.alias("alerted_amount"))
    return outcomes.join(per_event, "event_id", "left").select(
        "event_id", "chain", "address", "lt", "outcome",
        F.coalesce("status", F.lit("conflict")).alias("status"),
        F.coalesce("alerts", F.lit(0)).alias("alerts"),
        F.coalesce("alerted_amount", F.lit(0).cast("decimal(38,9)")).alias("alerted_amount"))


def handle_batch(arrivals: DataFrame, stored: DataFrame | None = None,
                 checkpoints: DataFrame | None = None) -> DataFrame:
    """Results of one batch of arrivals against stored ids and checkpoints."""
    fresh = first_arrival(arrivals) if stored is None else new_events(arrivals, stored)
    fresh = settle(fresh, "fresh")
    outcomes = settle(checkpoint_fold(fresh, checkpoints), "outcomes")
    conflicts = settle(checkpoint_conflicts(outcomes), "conflicts")
    return event_results(outcomes, judge(fresh, conflicts))
