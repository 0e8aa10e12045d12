"""Checkpoint lag: processing time since the last advance, per chain and address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from walletscope import params


def checkpoint_timestamps(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.groupBy("chain", "address").agg(F.max("updated_at").alias("updated_at"))


def event_lag(checkpoints: DataFrame, as_of: Column) -> DataFrame:
    lag = (F.unix_micros(as_of) - F.unix_micros("updated_at")) / F.lit(1e6)
    return checkpoint_timestamps(checkpoints).withColumn("lag_seconds", lag)


def _limit(threshold_seconds: int) -> int:
    return threshold_seconds if threshold_seconds > 0 else params.STALE_LAG_SECONDS


def stale_checkpoints(checkpoints: DataFrame, as_of: Column,
                      threshold_seconds: int = params.STALE_LAG_SECONDS) -> DataFrame:
    return event_lag(checkpoints, as_of).where(F.col("lag_seconds") > _limit(threshold_seconds))


def stale_wallets_by_chain(checkpoints: DataFrame, as_of: Column,
                           threshold_seconds: int = params.STALE_LAG_SECONDS) -> DataFrame:
    """Stale wallets of every known chain, 0 included."""
    return event_lag(checkpoints, as_of).groupBy("chain").agg(
        F.count_if(F.col("lag_seconds") > _limit(threshold_seconds)).alias("stale_wallets"))


def max_lag(checkpoints: DataFrame, as_of: Column) -> DataFrame:
    return event_lag(checkpoints, as_of).agg(F.max("lag_seconds").alias("max_lag_seconds"))
