"""Distinct counts that merge: a sketch per day is stored once, and any span of days is a merge of its sketches.

An exact distinct count reads and shuffles every row again. A day's HyperLogLog sketch has a
fixed size, so a question over years reads some kilobytes a day. The exact forms stay in
``operators.diagnostics``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Base-2 logarithm of the registers of a sketch.
REGISTERS_LOG = 14


def error_bound(sigmas: float = 4.0, registers_log: int = REGISTERS_LOG) -> float:
    """The relative error that an estimate stays within, but for a chance of some 1 in 10,000 at four sigmas."""
    return sigmas * 1.04 / 2 ** (registers_log / 2)


def daily(rows: DataFrame, keys: Sequence[str], ts: str, counted: Sequence[str]) -> DataFrame:
    """keys, day, rows, and for each counted column its sketch; pre-aggregated before the shuffle."""
    sketches = [F.hll_sketch_agg(c, REGISTERS_LOG).alias(f"{c}_sketch") for c in counted]
    return (rows.groupBy(*keys, F.to_date(ts).alias("day"))
            .agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"), *sketches))


def merged(days: DataFrame, keys: Sequence[str], counted: Sequence[str], among: Column | None = None) -> DataFrame:
    """Rows and estimated distinct counts by key over all days, or over those ``among`` holds for."""
    some = days if among is None else days.where(among)
    distinct = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}_estimate") for c in counted]
    return some.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.min("first_at").alias("first_at"),
                                   F.max("last_at").alias("last_at"), *distinct)


def within(estimate: Column, exact: Column, sigmas: float = 4.0) -> Column:
    """Whether an estimate lies within its bound of the exact number."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * F.lit(error_bound(sigmas)))
