"""Retry and dead-letter rule over a table of failed delivery attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from walletscope import params


def dead_letters(attempts: DataFrame, max_retries: int = params.MAX_RETRIES,
                 delays: tuple[int, ...] = params.RETRY_DELAYS_SECONDS) -> DataFrame:
    """Fate of each failed message, keyed by message id.

    ``attempts(queue, message_id, undecodable)`` has one row per failed delivery.
    An undecodable body is dead at once, others after ``max_retries`` failures;
    below that the message waits (the last delay repeats).
    """
    failed = attempts.groupBy("queue", "message_id").agg(
        F.count("*").alias("attempts"), F.bool_or("undecodable").alias("undecodable"))
    reason = (F.when(F.col("undecodable"), "undecodable")
              .when(F.col("attempts") >= max_retries, "max_retries"))
    at = F.least(F.col("attempts"), F.lit(len(delays))).cast("int")
    delay = F.element_at(F.array(*[F.lit(d) for d in delays]), at)
    return (failed.withColumn("reason", reason)
            .select("queue", "message_id", "attempts",
                    F.when(F.col("reason").isNull(), "retry").otherwise("dead").alias("disposition"),
                    "reason", F.when(F.col("reason").isNull(), delay).alias("delay_seconds")))


def dlq_depth(letters: DataFrame) -> DataFrame:
    """Dead messages per queue; a queue with none shows 0."""
    return letters.groupBy("queue").agg(
        F.count_if(F.col("disposition") == "dead").alias("dead_messages"))
