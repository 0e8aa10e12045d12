"""The stored tables: events and their ids, checkpoints, state tables, text lines.

All but the text lines are written batch by batch and committed whole (``sinks.commits``).

An event id is a digest of chain, address, lt and transaction hash. So an id that is the
digest of its row can only be stored under the same chain and lt: its lookup reads the batches
whose lt spans it falls into, and in their files, sorted by chain and lt, the row groups that
can hold it. Ids that are no such digest are kept apart and looked up everywhere.
"""

from __future__ import annotations

import uuid
from bisect import bisect_left
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from walletscope import schemas
from walletscope.functions import event_id
from walletscope.schemas import WALLET
from walletscope.sinks.commits import Batch, commit, entries, others, read, write

EVENT_ROW = ("event_id string, chain string, address string, provider string, lt bigint, "
             "tx_hash string, block_time timestamp, raw_json string, correlation_id string, "
             "arrival_seq bigint, arrived_at timestamp, created_at timestamp")
ID_ROW = "event_id string, chain string, lt bigint"
#: Folders of a checkpoint base, so that a batch reads those of its wallets.
BUCKETS = 64
#: Spans of lt kept per chain and batch; ranges pushed down into one scan at most.
SPANS, RANGES = 32, 256
#: Files of a chain and date where Spark does not size them itself.
DATE_PARTS = 4
#: A base is written anew after so many batches, or when the moves since outgrow it.
BASE_BATCHES = 32


# ---- events and their ids ------------------------------------------------------------

def lt_spans(rows: DataFrame) -> DataFrame:
    """(chain, lo, hi) that cover all ``lt`` of the rows, some ``SPANS`` per chain; stragglers get their own."""
    ends = rows.groupBy("chain").agg(F.min("lt").alias("_lo"), F.max("lt").alias("_hi"))
    width = F.greatest(F.lit(1), F.ceil((F.col("_hi") - F.col("_lo") + 1) / SPANS))
    cell = F.floor((F.col("lt") - F.col("_lo")) / width)
    return (rows.select("chain", "lt").join(ends, "chain").groupBy("chain", cell.alias("_cell"))
            .agg(F.min("lt").alias("lo"), F.max("lt").alias("hi")).drop("_cell"))


def _derived() -> Column:
    return F.coalesce(F.col("event_id") == event_id("chain", "address", "lt", "tx_hash"), F.lit(False))


def _by_date(rows: DataFrame) -> DataFrame:
    """Rows dealt by chain and block date, so that not every task writes a file for every date.

    The rebalance hint sizes the files per date and splits a date that is too big. Spark plans the
    batches of a stream with state without adaptive execution, and drops the hint there; then a date
    is dealt over ``DATE_PARTS`` tasks.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", "chain", "block_date")
    return rows.repartition("chain", "block_date", F.pmod(F.xxhash64("event_id"), F.lit(DATE_PARTS)))


def write_events(fresh: DataFrame, root: str, batch: Batch, created_at: Column | None = None) -> DataFrame:
    """New events, laid out by chain and block date, and their ids, sorted by chain and lt.

    Gives the events as stored. Foreign ids are counted while the events are written; where there are
    none, no digest is made again. A chain whose text does not come back from the name of a folder counts too.
    """
    stamped = fresh.withColumn("created_at", F.current_timestamp() if created_at is None else created_at)
    foreign = F.count_if(~_derived() | F.col("chain").isin("", "__HIVE_DEFAULT_PARTITION__"))
    write(_by_date(stamped.withColumn("block_date", F.to_date("block_time"))), root, "events", batch, ["chain", "block_date"],
          also={"foreign": foreign})
    stored = fresh.sparkSession.read.schema(EVENT_ROW).parquet(batch.folder(root, "events"))
    ids = stored.select("event_id", "chain", "lt", _derived().alias("_derived"))
    if batch.seen is not None and not batch.seen["events.foreign"]:
        derived, strange = ids, ids.limit(0)
    else:
        derived, strange = ids.where("_derived"), ids.where("NOT _derived")
    write(derived.drop("_derived").repartitionByRange("chain", "lt").sortWithinPartitions("chain", "lt"), root, "event_ids", batch)
    write(strange.drop("_derived"), root, "foreign_ids", batch)
    return stored


def stored_tables(batch: Batch) -> list[str]:
    """The event tables of an attempt; those for odd rows only if there are any, so that nobody reads empty ones."""
    return ["events", "event_ids", *(t for t in ("foreign_ids", "unidentified") if batch.seen[t])]


def spans_of(root: str, batch: Batch, spark: SparkSession) -> list:
    """The lt spans of the ids that an attempt has written: a bounded number per chain."""
    if not batch.seen["event_ids"]:
        return []
    ids = spark.read.schema(ID_ROW).parquet(batch.folder(root, "event_ids"))
    return lt_spans(ids).select("chain", "lo", "hi").collect()


def read_events(spark: SparkSession, root: str) -> DataFrame:
    return read(spark, root, "events", f"{EVENT_ROW}, block_date date")


def stored_ids(arrivals: DataFrame, root: str, batch: Batch, among: Sequence[Row] | None = None) -> DataFrame:
    """Ids stored by other batches (or ``among`` these) that can equal an id of the arrivals.

    Collected are the arrivals' lt spans, a bounded number per chain.
    """
    spark = arrivals.sparkSession
    known = entries(spark, root, batch) if among is None else among
    narrow = arrivals.where("event_id IS NOT NULL").select("event_id", "chain", "lt", _derived().alias("_derived"))
    ids = read(spark, root, "foreign_ids", ID_ROW, known).select("event_id")
    if any("event_ids" in e["tables"] for e in known):
        strange = narrow.where("NOT _derived").select("event_id")
        odd = not strange.isEmpty()
        # Digests are made once, to see that all ids are such; the spans then need none.
        ids = ids.unionByName(_of_spans(spark, root, known, lt_spans(narrow.where("_derived") if odd else narrow).collect()))
        if odd:
            everywhere = read(spark, root, "event_ids", ID_ROW, known).select("event_id")
            ids = ids.unionByName(everywhere.join(strange, "event_id", "left_semi"))
    return ids


def meeting(known: Sequence[Row], spans: Sequence[Row]) -> list[Row]:
    """The batches with an lt span that meets one of the given spans, which are disjoint per chain."""
    ends: dict[str, list[tuple[int, int]]] = {}
    for s in spans:
        ends.setdefault(s["chain"], []).append((s["hi"], s["lo"]))
    for each in ends.values():
        each.sort()

    def meets(span: Row) -> bool:
        mine = ends.get(span["chain"], [])
        at = bisect_left(mine, (span["lo"],))
        return at < len(mine) and mine[at][1] <= span["hi"]

    return [e for e in known if any(map(meets, e["spans"]))]


def _of_spans(spark: SparkSession, root: str, known: Sequence[Row], spans: Sequence[Row]) -> DataFrame:
    """Ids of the batches that meet the spans, with the spans as filters for the scan."""
    ids = read(spark, root, "event_ids", ID_ROW, meeting(known, spans))
    if 0 < len(spans) <= RANGES:
        ids = ids.where(reduce(or_, [(F.col("chain") == s["chain"]) & F.col("lt").between(s["lo"], s["hi"]) for s in spans]))
    return ids.select("event_id")


def ids_near(arrivals: DataFrame, root: str, batch: Batch, horizon: str) -> DataFrame:
    """Ids stored by other batches for dates within ``horizon`` of the arrivals' block dates."""
    span = arrivals.agg(F.to_date(F.min("block_time") - F.expr(f"INTERVAL {horizon}")),
                        F.to_date(F.max("block_time") + F.expr(f"INTERVAL {horizon}"))).first()
    stored = read_events(arrivals.sparkSession, root)
    return stored.where(others(batch) & F.col("block_date").between(*span)).select("event_id")


# ---- checkpoints -----------------------------------------------------------------------

def _bucket(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def _latest(moves: DataFrame) -> DataFrame:
    """A wallet's checkpoint only ever rises, so its largest move is its state."""
    top = F.max(F.struct("last_lt", "last_hash", "updated_at")).alias("top")
    return moves.groupBy(*WALLET).agg(top).select(*WALLET, "top.last_lt", "top.last_hash", "top.updated_at")


class Marks(NamedTuple):
    """The newest checkpoint base, the moves since, and how many rows and batches these are."""

    base: DataFrame
    moves: DataFrame
    base_rows: int
    later_moves: int
    later_batches: int


def _marks(spark: SparkSession, root: str, known: Sequence[Row]) -> Marks:
    """A base holds what was known before its own batch, so the batch's own moves count as later."""
    base = max((e for e in known if "checkpoint_base" in e["tables"]), key=lambda e: e["place"], default=None)
    later = [e for e in known if base is None or e["place"] >= base["place"]]
    columns = [c.split()[0] for c in schemas.CHECKPOINTS.split(", ")]
    held = read(spark, root, "checkpoint_base", f"{schemas.CHECKPOINTS}, bucket int", [base] if base else [])
    return Marks(held.select(*columns, "bucket"), read(spark, root, "checkpoints", schemas.CHECKPOINTS, later).select(*columns),
                 base["base_rows"] if base else 0, sum(e["moves"] for e in later), len(later))


def read_checkpoints(spark: SparkSession, root: str) -> DataFrame:
    marks = _marks(spark, root, entries(spark, root))
    return _latest(marks.base.drop("bucket").unionByName(marks.moves))


def checkpoints_before(arrivals: DataFrame, root: str, batch: Batch) -> DataFrame:
    """Checkpoints of the arrivals' wallets as other batches have left them.

    Read are the base's buckets of those wallets and the moves since the base; only those wallets are folded.
    """
    spark = arrivals.sparkSession
    wallets = arrivals.select(*WALLET).distinct()
    buckets = [r["bucket"] for r in wallets.select(_bucket(*WALLET).alias("bucket")).distinct().collect()]
    marks = _marks(spark, root, entries(spark, root, batch))
    near = marks.base.where(F.col("bucket").isin(*buckets)).drop("bucket").unionByName(marks.moves)
    return _latest(near.join(wallets, WALLET, "left_semi"))


def write_checkpoints(changed: DataFrame, root: str, batch: Batch) -> int:
    """The checkpoints that a batch has moved; those of other wallets are not written again. Gives their number."""
    write(changed.select("chain", "address", "provider", "last_lt", "last_hash", "updated_at"), root, "checkpoints", batch)
    return batch.seen["checkpoints"]


def write_base(spark: SparkSession, root: str, batch: Batch) -> int | None:
    """The whole state before this batch as a new base, when the old one has fallen behind; its rows.

    A base is rewritten after as many moves as it has rows, so each move is copied a bounded
    number of times, and readers meet few more moves than wallets.
    """
    marks = _marks(spark, root, entries(spark, root, batch))
    outgrown = marks.later_moves > marks.base_rows and marks.later_batches > 1
    if not marks.later_moves or not (outgrown or marks.later_batches >= BASE_BATCHES):
        return None
    state = _latest(marks.base.drop("bucket").unionByName(marks.moves))
    laid_out = state.withColumn("bucket", _bucket(*WALLET)).hint("rebalance", "bucket")
    write(laid_out, root, "checkpoint_base", batch, ["bucket"])
    return batch.seen["checkpoint_base"]


def compact(spark: SparkSession, root: str, most: int = 64) -> bool:
    """Make the older batches of events one batch, if more than ``most`` count; whether it did.

    The newest batch of each run stays as it is, because a stream may run it again. All tables
    of the others are written anew, together, and take their place at one commit; a compaction that dies
    changes nothing. Each compaction takes up the one before only if it is no larger than all the rest, so
    a row is copied a number of times that grows with the logarithm of the batches.
    """
    known = sorted((e for e in entries(spark, root) if "events" in e["tables"]), key=lambda e: e["place"])
    newest = {run: max(e["batch"] for e in known if e["run"] == run) for run in {e["run"] for e in known} - {"compacted"}}
    old = [e for e in known if newest.get(e["run"]) != e["batch"]]
    if len(known) <= most or len(old) < 2:
        return False
    while len(old) > 2 and old[0]["weight"] > sum(e["weight"] for e in old[1:]):
        old = old[1:]  # a large compacted batch rests until the others have grown to its size
    number = max((e["batch"] for e in known if e["run"] == "compacted"), default=-1) + 1
    whole = Batch("compacted", number, uuid.uuid4().hex, {})
    tables = sorted({t for e in old for t in e["tables"]} - {"checkpoints", "checkpoint_base"})
    for table in tables:
        _rewrite(spark, root, table, old, whole)
    base_rows, moves = _compact_checkpoints(spark, root, known, old, whole)
    marks = ["checkpoints"] + ["checkpoint_base"] * (base_rows is not None)
    commit(spark, root, whole, [*tables, *marks], spans_of(root, whole, spark), base_rows, moves, old)
    return True


def _rewrite(spark: SparkSession, root: str, table: str, old: Sequence[Row], whole: Batch) -> None:
    paths = [Batch(e["run"], e["batch"], e["attempt"]).folder(root, table) for e in old if table in e["tables"]]
    if table == "events":
        rows = read(spark, root, table, f"{EVENT_ROW}, block_date date", old).drop("run", "batch")
        write(rows.hint("rebalance", "chain", "block_date"), root, table, whole, ["chain", "block_date"])
    elif table == "event_ids":
        rows = read(spark, root, table, ID_ROW, old).drop("run", "batch")
        write(rows.repartitionByRange("chain", "lt").sortWithinPartitions("chain", "lt"), root, table, whole)
    else:
        rows = spark.read.option("basePath", f"{root}/{table}").parquet(*paths).drop("run", "batch", "attempt")
        write(rows.hint("rebalance"), root, table, whole)


def _compact_checkpoints(spark: SparkSession, root: str, known: Sequence[Row], old: Sequence[Row], whole: Batch) -> tuple[int | None, int]:
    """The rows of the new base, if the old batches hold the one in use, and the moves. Moves before it are in it already."""
    base = max((e for e in known if "checkpoint_base" in e["tables"]), key=lambda e: e["place"], default=None)
    marks = _marks(spark, root, [e for e in old if base is None or e["place"] >= base["place"]])
    state = _latest(marks.base.drop("bucket").unionByName(marks.moves))
    if base is None or base not in old:
        return None, write_checkpoints(state, root, whole)
    write(state.withColumn("bucket", _bucket(*WALLET)).hint("rebalance", "bucket"), root, "checkpoint_base", whole, ["bucket"])
    write_checkpoints(state.limit(0), root, whole)
    return whole.seen["checkpoint_base"], 0


# ---- state tables and lines -----------------------------------------------------------------

_STATES = {"checkpoints": schemas.CHECKPOINTS, "monitored_addresses": schemas.MONITORED_ADDRESSES}


def write_states(root: str, states: dict[str, DataFrame]) -> None:
    """A new version of one or more state tables; readers see all of them change at once.

    They may be made from ``read_state`` of the same root: earlier versions stay as they are.
    """
    spark = next(iter(states.values())).sparkSession
    last = max((e["batch"] for e in entries(spark, root) if e["run"] == "state"), default=-1)
    version = Batch("state", last + 1, uuid.uuid4().hex)
    for table, rows in states.items():
        write(rows, root, table, version)
    commit(spark, root, version, list(states))


def read_state(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The newest committed version of a state table."""
    held = [e for e in entries(spark, root) if e["run"] == "state" and table in e["tables"]]
    return read(spark, root, table, _STATES[table], sorted(held, key=lambda e: e["batch"])[-1:]).drop("run", "batch")


def write_lines(rows: DataFrame, path: str, mode: str = "append") -> None:
    """The ``line`` column as text files (alert lines, audit JSON lines)."""
    rows.select("line").write.mode(mode).text(path)


def line_sink(path: str, lines: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, str], None]:
    """An alert sink of text lines; a replayed batch overwrites its own folder."""
    def sink(alerts: DataFrame, batch: str) -> None:
        write_lines(lines(alerts), f"{path}/{batch}", "overwrite")

    return sink
