"""Counters and rates that a stream keeps up to date.

Counters are streaming aggregations in update mode: the state holds one total per label set,
a batch hands on the totals that changed, and these replace the old ones in a committed table.
Totals are written, not increments, so a replayed batch changes nothing.

Rates are built from minutes. A minute is counted once by a windowed aggregation and
handed on when the watermark has passed it; rows that come later are counted apart.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from walletscope.operators.rates import rate_of_minutes
from walletscope.sinks.commits import batch_of, commit, entries, read, write

Each = Callable[[DataFrame, int], None]
MINUTE = "series string, minute timestamp, n bigint"
_SEEN = "until timestamp, seen timestamp"


def _shape(keys: Sequence[str]) -> str:
    return ", ".join(f"{k} string" for k in keys) + ", total bigint"


def totals(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running totals of a stream by label columns, for update mode."""
    return stream.groupBy(*(F.col(k).cast("string").alias(k) for k in keys)).agg(F.count(F.lit(1)).alias("total"))


def upsert(root: str, table: str, keys: Sequence[str], run: str | None = None) -> Each:
    """Replace the totals that changed. The table has one row per label set, and is written whole."""
    def each(changed: DataFrame, number: int) -> None:
        spark, batch = changed.sparkSession, batch_of(changed, number, run)
        mine = [e for e in entries(spark, root, batch) if e["run"] == batch.run and table in e["tables"]]
        before = read(spark, root, table, _shape(keys), sorted(mine, key=lambda e: e["batch"])[-1:]).drop("run", "batch")
        both = before.withColumn("_new", F.lit(False)).unionByName(changed.withColumn("_new", F.lit(True)))
        last = both.groupBy(*keys).agg(F.max_by("total", "_new").alias("total"))
        write(last, root, table, batch)
        commit(spark, root, batch, [table])

    return each


def read_totals(spark: SparkSession, root: str, table: str, keys: Sequence[str]) -> DataFrame:
    """The current totals; each run (stream log) counts from zero, so runs add up."""
    newest: dict[str, tuple] = {}
    for e in entries(spark, root):
        if table in e["tables"] and (e["run"] not in newest or e["batch"] > newest[e["run"]]["batch"]):
            newest[e["run"]] = e
    rows = read(spark, root, table, _shape(keys), list(newest.values()))
    return rows.groupBy(*keys).agg(F.sum("total").cast("bigint").alias("total"))


def run_updates(stream: DataFrame, each: Each, checkpoint: str) -> None:
    """Process everything that is there in update mode, and stop."""
    (stream.writeStream.foreachBatch(each).outputMode("update").option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


# ---- rates ---------------------------------------------------------------------------------

def minutes(stream: DataFrame, ts: str, key: str, delay: str = "10 minutes") -> DataFrame:
    """Closed minutes of a stream, and beside them every row's time, for append mode."""
    narrow = stream.select(F.col(key).cast("string").alias("series"), F.col(ts).alias("at"))
    closed = (narrow.withWatermark("at", delay).groupBy("series", F.window("at", "1 minute").alias("_w"))
              .agg(F.count(F.lit(1)).alias("n")))
    return (closed.select("series", F.col("_w.start").alias("at"), "n")
            .unionByName(narrow.withColumn("n", F.lit(None).cast("bigint"))))


def keep_minutes(root: str, delay: str = "10 minutes", run: str | None = None) -> Each:
    """Keep closed minutes, and count rows whose minute the watermark had passed before their batch.

    The watermark of a batch is the latest time of the batches before, less the delay; a small table
    keeps it, so that a row is either in a closed minute or counted as late, and never both.
    """
    def each(rows: DataFrame, number: int) -> None:
        spark, batch = rows.sparkSession, batch_of(rows, number, run)
        mine = [e for e in entries(spark, root, batch) if e["run"] == batch.run and "watermarks" in e["tables"]]
        last = read(spark, root, "watermarks", _SEEN, sorted(mine, key=lambda e: e["batch"])[-1:]).select("seen").first()
        seen = F.lit(last["seen"] if last else None).cast("timestamp")
        until = F.date_trunc("millisecond", seen) - F.expr(f"INTERVAL {delay}")
        both = write(rows, root, "minute_rows", batch)
        write(both.where("n IS NOT NULL").select("series", F.col("at").alias("minute"), "n"), root, "minutes", batch)
        minute = F.date_trunc("minute", "at")
        late = both.where(F.col("n").isNull() & (minute + F.expr("INTERVAL 1 MINUTE") <= until))
        write(late.groupBy("series", minute.alias("minute")).agg(F.count(F.lit(1)).alias("n")), root, "late_minutes", batch)
        newest = both.where("n IS NULL").agg(F.max("at").alias("_at"))
        write(newest.select(until.alias("until"), F.greatest(seen, "_at").alias("seen")), root, "watermarks", batch)
        commit(spark, root, batch, ["minutes", "late_minutes", "watermarks"])

    return each


def closed_until(spark: SparkSession, root: str) -> Column:
    """The minute up to which all minutes have been handed on."""
    return F.lit(read(spark, root, "watermarks", _SEEN).agg(F.date_trunc("minute", F.max("until"))).first()[0]).cast("timestamp")


def read_rate(spark: SparkSession, root: str, span_minutes: int = 5) -> DataFrame:
    """The sliding rate over closed minutes, late rows included, for the windows that have closed."""
    end = closed_until(spark, root)
    counted = read(spark, root, "minutes", MINUTE).unionByName(read(spark, root, "late_minutes", MINUTE))
    whole = counted.where(F.col("minute") < end).groupBy("series", "minute").agg(F.sum("n").alias("n"))
    return rate_of_minutes(whole, "series", span_minutes).where(F.col("window_end") <= end)
