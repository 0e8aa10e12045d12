"""Running aggregates over an ordered key without one task per hot key.

A plain ``Window.partitionBy(key).orderBy(..)`` sorts every row of a key in one
task; a wallet or series holding a third of all rows would sit there alone. Here
hot keys are cut into slices of their order column. The frame is evaluated inside
(key, slice), and what earlier slices contribute is carried in from one
pre-aggregated row per slice. The result equals that of the plain window, and all
other keys are plain windows.

The input is read more than once (the others narrow), so it should be a table
scan or a settled result, not an expensive plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from walletscope.plans.hot import DEFAULT, HotRule, hot_keys, null_safe_join


def _running(df: DataFrame, keys: Sequence[str], order: Sequence, slice_by: Column, value: Column,
             name: str, inclusive: bool, rule: HotRule, agg: Callable, merge: Callable) -> DataFrame:
    hot = hot_keys(df, keys, rule, nulls=True).drop("_rows")
    group = [*keys, "_slice"]
    before = (Window.partitionBy(*keys).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = (null_safe_join(df, hot, keys, "inner").withColumn("_slice", slice_by)
             .groupBy(*group).agg(agg(value).alias("_total"))
             .select(*group, agg("_total").over(before).alias("_carry"))
             .where(F.col("_carry").isNotNull()))
    frame = (Window.partitionBy(*group).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    cut = (null_safe_join(df, hot, keys, "left")
           .withColumn("_slice", F.when(F.col("_hot"), slice_by)).drop("_hot"))
    # The explicit repartition matters: an input already hashed on the keys alone
    # would satisfy the window and bring the hot key back into one task.
    inner = cut.repartition(*group).withColumn("_inner", agg(value).over(frame))
    return (null_safe_join(inner, carry, group, "left")
            .withColumn(name, merge(F.col("_inner"), F.col("_carry")))
            .drop("_slice", "_inner", "_carry"))


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence, slice_by: Column,
                value: Column, name: str, inclusive: bool = False,
                rule: HotRule = DEFAULT) -> DataFrame:
    """Add ``name`` = max of ``value`` over the rows before (or up to) each row of its key.

    With ``value = struct(order, x)`` it is the stitched form of ``lag``.
    """
    return _running(df, keys, order, slice_by, value, name, inclusive, rule, F.max, F.greatest)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence, slice_by: Column,
                value: Column, name: str, inclusive: bool = False,
                rule: HotRule = DEFAULT) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the rows before (or up to) each row of its key."""
    def merge(inner: Column, carry: Column) -> Column:
        return F.coalesce(inner, F.lit(0)) + F.coalesce(carry, F.lit(0))

    return _running(df, keys, order, slice_by, value, name, inclusive, rule, F.sum, merge)
