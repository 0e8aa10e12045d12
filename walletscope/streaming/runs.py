"""Streaming queries: exact, date-bounded or watermark-bounded dedupe, running checkpoints, the whole handler.

All work per batch in foreachBatch against the tables of earlier batches, whichever run
wrote them. A batch reads the parts of those tables that can concern it, writes what it
changes, and commits all its tables at once at its end.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from walletscope import params
from walletscope.operators.alerts import alert_rows, decision_rows
from walletscope.operators.checkpoints import checkpoint_conflicts, checkpoint_fold, moved_checkpoints
from walletscope.operators.handle import event_results, judge
from walletscope.operators.ingest import first_arrival, new_events, unidentified
from walletscope.schemas import METRIC_SAMPLES
from walletscope.sinks.commits import Batch, batch_of, commit, entries, read, write
from walletscope.sinks.tables import (
    checkpoints_before, compact, ids_near, spans_of, stored_ids, stored_tables, write_base, write_checkpoints, write_events,
)
from walletscope.sources.plugins import AlertRule, AlertSink

Each = Callable[[DataFrame, int], None]
WHALES: Mapping[str, AlertRule] = {"whale": alert_rows}
_FOLD = ("chain string, address string, provider string, event_id string, lt bigint, tx_hash string, arrival_seq bigint, "
         "arrived_at timestamp, outcome string")
#: Columns of the tables that ``track`` and ``handle`` write beside events and checkpoints.
SHAPES = {
    "outcomes": _FOLD, "conflicts": _FOLD,
    "results": ("event_id string, chain string, address string, lt bigint, outcome string, status string, alerts int, "
                "alerted_amount decimal(38,9)"),
}


def read_output(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One of ``SHAPES`` as committed."""
    return read(spark, root, table, SHAPES[table])


def _store(arrivals: DataFrame, root: str, batch: Batch, fresh: DataFrame, created_at: Column | None) -> DataFrame:
    """Write new events; arrivals without an id go to a table of their own."""
    write(unidentified(arrivals), root, "unidentified", batch)
    return write_events(fresh, root, batch, created_at)


def _commit_events(spark: SparkSession, root: str, batch: Batch) -> None:
    commit(spark, root, batch, stored_tables(batch), spans_of(root, batch, spark))


def store_new(root: str, created_at: Column | None = None, run: str | None = None) -> Each:
    """Exact idempotence: first arrivals that no other batch has stored."""
    def each(arrivals: DataFrame, number: int) -> None:
        batch = batch_of(arrivals, number, run)
        _store(arrivals, root, batch, new_events(arrivals, stored_ids(arrivals, root, batch)), created_at)
        _commit_events(arrivals.sparkSession, root, batch)

    return each


def store_within(root: str, horizon: str = "1 day", created_at: Column | None = None, run: str | None = None) -> Each:
    """Dedupe against stored events of nearby dates only.

    A copy whose block time lies further than ``horizon`` from the batch's block times may
    pass. A new event is stored however late it comes.
    """
    def each(arrivals: DataFrame, number: int) -> None:
        batch = batch_of(arrivals, number, run)
        _store(arrivals, root, batch, new_events(arrivals, ids_near(arrivals, root, batch, horizon)), created_at)
        _commit_events(arrivals.sparkSession, root, batch)

    return each


def within_watermark(stream: DataFrame, horizon: str = "1 day") -> DataFrame:
    """The stream with a flag ``fresh``: rows that Spark's watermark state passes as first of their id.

    Each such row comes twice, once as its id and time with the flag and once among all arrivals; only ids
    and times enter the state's shuffle. The state holds the ids of the horizon only; what it drops is a copy or
    lies behind the watermark.
    """
    narrow = stream.select("event_id", "block_time").withWatermark("block_time", horizon)
    first = narrow.dropDuplicatesWithinWatermark(["event_id"]).withColumn("fresh", F.lit(True))
    return stream.withColumn("fresh", F.lit(False)).unionByName(first, allowMissingColumns=True)


def store_passed(root: str, created_at: Column | None = None, run: str | None = None) -> Each:
    """Store what ``within_watermark`` has passed; look up exactly what it has dropped, and what it cannot know.

    Rows that the state passes are new to their run, so they are looked up among other runs'
    batches only. Dropped rows, copies and late ones, are looked up everywhere: a new event is
    stored however late it comes. A copy whose block time is more than the horizon younger than that of
    the stored event may pass.
    """
    def each(flagged: DataFrame, number: int) -> None:
        spark, batch = flagged.sparkSession, batch_of(flagged, number, run)
        both = write(flagged, root, "arrived", batch)
        arrivals, passed = (both.where(F.col("fresh") == f).drop("fresh") for f in (False, True))
        passed = passed.where("event_id IS NOT NULL")
        # The state keeps any row of an id; the first arrival of the batch is the one to store. An id has passed
        # or not, so the documents move once, and what follows reads the first arrivals of both kinds.
        flagged_ids = passed.select("event_id", F.lit(True).alias("passed"))
        once = write(first_arrival(arrivals.join(flagged_ids, "event_id", "left")), root, "firsts", batch)
        first, dropped = once.where("passed").drop("passed"), once.where("passed IS NULL").drop("passed")
        known = entries(spark, root, batch)
        strangers = [e for e in known if e["run"] != batch.run]
        fresh = first if not strangers else first.join(stored_ids(first, root, batch, strangers), "event_id", "left_anti")
        late = dropped.join(stored_ids(dropped, root, batch, known), "event_id", "left_anti")
        _store(arrivals, root, batch, fresh.unionByName(late.select(*fresh.columns)), created_at)
        _commit_events(spark, root, batch)

    return each


def _track(arrivals: DataFrame, root: str, batch: Batch, created_at: Column | None) -> tuple[DataFrame, DataFrame, int | None, int]:
    """New events, conflicts, the rows of a new checkpoint base and the number of moves, all written and not committed.

    The new events are written first and read back: later steps start from that
    table, so a lost executor never repeats the dedupe.
    """
    spark = arrivals.sparkSession
    fresh = _store(arrivals, root, batch, new_events(arrivals, stored_ids(arrivals, root, batch)), created_at)
    folded = checkpoint_fold(fresh, checkpoints_before(fresh, root, batch)).select(*_names("outcomes"))
    outcomes = write(folded, root, "outcomes", batch, also={o: F.count_if(F.col("outcome") == o) for o in ("advance", "conflict", "ignore")})
    moves = write_checkpoints(moved_checkpoints(outcomes), root, batch)
    conflicts = write(checkpoint_conflicts(outcomes), root, "conflicts", batch)
    return fresh, conflicts, write_base(spark, root, batch), moves


def _names(table: str) -> list[str]:
    return [c.split()[0] for c in SHAPES[table].split(", ")]


def _commit_all(spark: SparkSession, root: str, batch: Batch, base_rows: int | None, moves: int, *more: str) -> None:
    base = () if base_rows is None else ("checkpoint_base",)
    commit(spark, root, batch, [*stored_tables(batch), "outcomes", "conflicts", "checkpoints", *base, *more],
           spans_of(root, batch, spark), base_rows, moves)


def track(root: str, created_at: Column | None = None, run: str | None = None) -> Each:
    """Store new events, move the checkpoints of their wallets and keep outcomes and conflicts."""
    def each(arrivals: DataFrame, number: int) -> None:
        batch = batch_of(arrivals, number, run)
        *_, base_rows, moves = _track(arrivals, root, batch, created_at)
        _commit_all(arrivals.sparkSession, root, batch, base_rows, moves)

    return each


def handle(root: str, created_at: Column | None = None, decided_at: Column | None = None,
           threshold=params.ALERT_THRESHOLD, rules: Mapping[str, AlertRule] = WHALES, sinks: Sequence[AlertSink] = (),
           run: str | None = None) -> Each:
    """The whole consumer as a foreachBatch function over the tables below ``root``.

    Each of ``rules`` makes alerts of the judged events; each of ``sinks`` is called with the
    alerts of the batch and the batch's name, once per rule, before the batch is committed: a
    replayed batch calls them again with the same rows and name.
    """
    def each(arrivals: DataFrame, number: int) -> None:
        spark, batch = arrivals.sparkSession, batch_of(arrivals, number, run)
        fresh, conflicts, base_rows, moves = _track(arrivals, root, batch, created_at)
        outcomes = spark.read.parquet(batch.folder(root, "outcomes"))
        judged = write(judge(fresh, conflicts, threshold), root, "judged", batch, also={
            "alerts": F.sum(F.coalesce(F.size("hits"), F.lit(0)).cast("bigint")),
            "failed": F.count_if(F.col("status") == params.EVALUATION_ERROR)})
        at = F.current_timestamp() if decided_at is None else decided_at
        write(decision_rows(judged, at), root, "decisions", batch)
        write(judged.where(F.col("status") == params.EVALUATION_ERROR).drop("hits"), root, "failed_events", batch)
        write(event_results(outcomes, judged).select(*_names("results")), root, "results", batch)
        for name, rule in rules.items():
            for sink in sinks:
                sink(rule(judged), f"rule={name}/{batch.name}")
        write(_metrics(spark, batch, at), root, "metrics", batch)
        _commit_all(spark, root, batch, base_rows, moves, "judged", "decisions", "failed_events", "results", "metrics")

    return each


#: Metrics of a batch and where its writes have observed them.
OBSERVED = {"events_stored": "events", "events_unidentified": "unidentified", "checkpoints_advanced": "outcomes.advance",
            "checkpoint_conflicts": "outcomes.conflict", "checkpoints_ignored": "outcomes.ignore", "events_evaluated": "judged",
            "events_failed": "judged.failed", "alerts_fired": "judged.alerts", "decisions_logged": "decisions"}


def _metrics(spark: SparkSession, batch: Batch, at: Column) -> DataFrame:
    """A batch's counters as sample rows, from what its writes have observed: no table is read again."""
    rows = [(metric, float(batch.seen[name])) for metric, name in OBSERVED.items()]
    return spark.createDataFrame(rows, "metric string, value double").select(
        "metric", F.create_map().cast("map<string,string>").alias("labels"), at.alias("ts"), "value")


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Sample rows of all committed batches, with run and batch."""
    return read(spark, root, "metrics", METRIC_SAMPLES)


def compacting(root: str, each: Each, most: int = 64) -> Each:
    """``each``, followed by a compaction of ``root`` whenever more than ``most`` batches have gathered."""
    def run(rows: DataFrame, number: int) -> None:
        each(rows, number)
        compact(rows.sparkSession, root, most)

    return run


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], object], checkpoint: str) -> None:
    """Process everything that is there, batch by batch, and stop."""
    def run(batch: DataFrame, number: int) -> None:
        each(batch, number)

    (stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def append_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append a stream's rows to files; the file sink's log makes each batch count once."""
    (stream.writeStream.format(fmt).outputMode("append").option("path", path)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination())
