"""Equi join of a large table with per-key state when single keys are hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from walletscope.plans.hot import DEFAULT, HotRule, hot_keys


def spread_join(big: DataFrame, state: DataFrame, on: Sequence[str], how: str, spread_by: str,
                rule: HotRule = DEFAULT) -> DataFrame:
    """Join ``big`` to ``state`` with the rows of hot keys spread over as many buckets as they need.

    A hot key gets a bucket per ``rule.rows`` of its rows, whatever the size of the data.
    Its rows are salted by ``spread_by`` (a value, so a re-run task salts alike) and its
    state row is repeated per bucket; all other keys join as usual. Spark's own skew split
    acts on sort-merge joins without an operator above that needs the keys together, which
    the limits per key above these joins are. Rows with a NULL key match nothing and are
    spread too. Works for inner, left, left_semi and left_anti, where ``state`` is the right side.
    """
    hot = hot_keys(big, on, rule)
    unknown = reduce(or_, [F.col(k).isNull() for k in on])
    buckets = F.ceil(F.col("_rows") / max(rule.rows, 1)).cast("bigint")
    salt = (F.when(F.col("_hot"), F.pmod(F.xxhash64(spread_by), buckets))
            .when(unknown, F.xxhash64(spread_by)).otherwise(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0).cast("bigint"), buckets - 1)
                    ).otherwise(F.array(F.lit(0).cast("bigint")))
    left = big.join(hot, list(on), "left").withColumn("_salt", salt).drop("_hot", "_rows")
    right = state.join(hot, list(on), "left").withColumn("_salt", F.explode(copies)).drop("_hot", "_rows")
    return left.join(right, [*on, "_salt"], how).drop("_salt")
