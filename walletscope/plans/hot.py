"""Keys that hold too many rows for one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class HotRule:
    """A key with more than ``rows`` rows is hot, up to the ``keys`` largest.

    Both are tuning parameters: they choose the plan and never the rows of a result.
    ``rows`` is what one task may hold. The list has at most ``keys`` entries whatever the
    data, so it may be broadcast. Keys left out are no larger than the smallest listed one,
    that is at most 1/``keys`` of all rows.
    """

    rows: int = 1_000_000
    keys: int = 100_000


DEFAULT = HotRule()


def hot_keys(df: DataFrame, keys: Sequence[str], rule: HotRule = DEFAULT, nulls: bool = False) -> DataFrame:
    """The hot keys of ``df`` with a ``_hot`` flag and their rows ``_rows``, marked for broadcast.

    One narrow count by key, aggregated before its shuffle. Without hot keys the
    adaptive plan drops whatever is joined to the empty result. Keys with a NULL are
    listed only if ``nulls`` is set.
    """
    known = F.lit(True) if nulls else reduce(and_, [F.col(k).isNotNull() for k in keys])
    largest = (df.where(known).groupBy(*keys).count().where(F.col("count") > rule.rows)
               .orderBy(F.desc("count"), *keys).limit(rule.keys))
    return F.broadcast(largest.select(*keys, F.lit(True).alias("_hot"), F.col("count").alias("_rows")))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi join in which NULL keys meet; the columns of ``on`` are those of ``left``."""
    renamed = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return left.join(renamed, same, how).drop(*(f"_on_{c}" for c in on))
