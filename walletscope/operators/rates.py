"""Per-second rates over sliding windows, from raw rows or from counter samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from walletscope.plans.running import running_max

ALL = "*"


def rate_of_minutes(minutes: DataFrame, key: str, span: int) -> DataFrame:
    """Minute totals to the windows [end - span, end) that contain them, for each key and for all.

    Between a series' first and last minute every window has a row, with 0 where it is empty.
    """
    step = F.expr("interval 1 minute")
    counted = (minutes.select(F.explode(F.array(F.col(key), F.lit(ALL))).alias("series"), "minute", "n")
               .groupBy("series", "minute").agg(F.sum("n").alias("n")))
    empty = counted.groupBy("series").agg(F.min("minute").alias("_a"), F.max("minute").alias("_b")).select(
        "series", F.explode(F.sequence("_a", "_b", step)).alias("minute"),
        F.lit(0).cast(counted.schema["n"].dataType).alias("n"))
    ends = F.sequence(F.col("minute") + step, F.col("minute") + step * span, step)
    return (counted.unionByName(empty).select("series", F.explode(ends).alias("window_end"), "n")
            .groupBy("series", "window_end").agg(F.sum("n").alias("increase"))
            .withColumn("rate", F.col("increase") / F.lit(60.0 * span)))


def rate(rows: DataFrame, ts: Column, key: str, span_minutes: int = 5) -> DataFrame:
    """Rows per second by ``key`` and in total, at every full minute from the first row to the last.

    Rows are counted per minute before they are assigned to windows, so the
    shuffle carries minutes, not rows times windows.
    """
    minutes = (rows.groupBy(F.col(key), F.date_trunc("minute", ts).alias("minute"))
               .agg(F.count("*").alias("n")))
    return rate_of_minutes(minutes, key, span_minutes)


def counter_increases(samples: DataFrame) -> DataFrame:
    """Increase of a counter series at each sample; a drop is a reset, counted from zero.

    The first sample of a series has nothing to compare with and adds nothing.
    """
    seen = running_max(samples, ["series"], ["ts"], F.date_trunc("day", F.col("ts")),
                       F.struct("ts", "value"), "last")
    last = F.col("last.value")
    grown = F.when(last.isNull(), F.lit(0.0)).when(F.col("value") < last, F.col("value")
                                                   ).otherwise(F.col("value") - last)
    return seen.withColumn("increase", grown).drop("last")


def counter_rate(samples: DataFrame, span_minutes: int = 5) -> DataFrame:
    """The same rate from counter samples ``(series, ts, value)``."""
    minutes = (counter_increases(samples)
               .groupBy("series", F.date_trunc("minute", "ts").alias("minute"))
               .agg(F.sum("increase").alias("n")))
    return rate_of_minutes(minutes, "series", span_minutes)
