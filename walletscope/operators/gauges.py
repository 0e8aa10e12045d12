"""Current gauge values from metric samples, and their dashboard bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from walletscope import params


def series_key(labels: Column) -> Column:
    """Labels as sorted ``name=value`` text, usable as a grouping key."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(pairs, ",")


def last_values(samples: DataFrame) -> DataFrame:
    """Last value of every series."""
    return samples.groupBy("metric", "series").agg(
        F.max_by("value", F.struct("ts", "sample_id")).alias("value"))


def gauge_sums(samples: DataFrame) -> DataFrame:
    """Last values summed over the series of each metric."""
    return last_values(samples).groupBy("metric").agg(F.sum("value").alias("value"))


def gauge_max_series(samples: DataFrame, metric: str, lookback_minutes: int = 5) -> DataFrame:
    """Maximum over the last values of all series of one metric, per minute.

    A series keeps its last value for ``lookback_minutes`` after the minute of its sample.
    """
    step = F.expr("interval 1 minute")
    last = (samples.where(F.col("metric") == metric)
            .groupBy("series", F.date_trunc("minute", "ts").alias("at"))
            .agg(F.max_by("value", F.struct("ts", "sample_id")).alias("value")))
    until = F.sequence(F.col("at"), F.col("at") + step * (lookback_minutes - 1), step)
    held = (last.select("series", F.explode(until).alias("minute"), "at", "value")
            .groupBy("series", "minute").agg(F.max_by("value", "at").alias("value")))
    return held.groupBy("minute").agg(F.max("value").alias("value"))


def discovery_age(samples: DataFrame, as_of: Column,
                  metric: str = "discovery_last_success_timestamp_seconds") -> DataFrame:
    """Seconds since the last successful discovery; without any, since the epoch."""
    last = F.coalesce(F.max_by("value", F.struct("ts", "sample_id")), F.lit(0.0))
    return (samples.where(F.col("metric") == metric).agg(last.alias("last_success"))
            .withColumn("age_seconds", F.unix_micros(as_of) / F.lit(1e6) - F.col("last_success")))


def health_bands(values: DataFrame, bands: dict = params.HEALTH_BANDS) -> DataFrame:
    """Band of each ``(metric, value)`` that has thresholds; reaching one is enough."""
    def band(metric: str) -> Column:
        yellow, red = bands[metric]
        colour = F.when(F.col("value") >= red, "red")
        if yellow is not None:
            colour = colour.when(F.col("value") >= yellow, "yellow")
        return colour.otherwise("green")

    chosen = reduce(lambda acc, m: acc.when(F.col("metric") == m, band(m)), bands, F)
    return values.where(F.col("metric").isin(*bands)).withColumn("band", chosen)
