"""Batches become visible whole: tables are written aside, one small file names them all.

A batch writes each of its tables into a folder of its own, ``table/run=../batch=../attempt=..``.
Nobody reads these before the batch is committed, which is the appearance of one single-row
file in the manifest. The last committed attempt of a batch counts, so a batch that is run
again replaces its rows, and one that died half-way leaves nothing to see.

The manifest is kept in eras of ``ERA`` commits. The first file of an era repeats all that
counted before, so a reader opens the files of the last two eras, however many batches there
are. One writer commits to a root at a time; readers never wait.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

#: Commits of an era.
ERA = 64
ENTRY = ("seq bigint, run string, batch bigint, attempt string, tables array<string>, "
         "spans array<struct<chain: string, lo: bigint, hi: bigint>>, base_rows bigint, moves bigint, place bigint, weight bigint, "
         "replaces array<struct<run: string, batch: bigint, attempt: string>>")


class Batch(NamedTuple):
    """A batch of a run, and the attempt in hand with what its writes have observed: rows by table, and more."""

    run: str
    number: int
    attempt: str = "0"
    seen: dict[str, int] | None = None

    @property
    def name(self) -> str:
        return f"run={self.run}/batch={self.number}"

    def folder(self, root: str, table: str) -> str:
        return f"{root}/{table}/{self.name}/attempt={self.attempt}"


def batch_of(df: DataFrame, number: int, run: str | None = None) -> Batch:
    """A new attempt at a batch; in a stream its log names the run, so a replay has the same name.

    Outside a stream the caller must name the run: two calls with the same number would
    otherwise pass for one batch, and the second would replace the first.
    """
    run = run or df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not run:
        raise ValueError("name the run: outside a stream nothing else tells its batches from those of other runs")
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"a run names a folder: {run!r}")
    return Batch(run, number, uuid.uuid4().hex, {})


def others(batch: Batch) -> Column:
    """Rows of other batches: of other runs, and of this run's earlier batches."""
    return (F.col("run") != batch.run) | (F.col("batch") < batch.number)


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, none if it is not there."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def _era_folders(spark: SparkSession, root: str) -> list[str]:
    """The last two eras that hold a file, the newest first."""
    found: list[str] = []
    for number in sorted((int(n.removeprefix("era=")) for n in _names(spark, f"{root}/manifest") if n.startswith("era=")), reverse=True):
        folder = f"{root}/manifest/era={number}"
        if any(n.startswith("part-") for n in _names(spark, folder)):
            found.append(folder)
        if len(found) == 2:
            break
    return found


def entries(spark: SparkSession, root: str, besides: Batch | None = None) -> list[Row]:
    """One row per batch that counts, with its last attempt; those of other batches only, if one is given.

    ``place`` orders them by when their rows were first committed, ``weight`` is how many batches have
    gone into one. Batches that a compaction has
    taken up count no longer; streams compact as they go, so the list stays short.
    """
    folders = _era_folders(spark, root)
    if not folders:
        return []
    last: dict[tuple[str, int], Row] = {}
    for e in sorted(spark.read.schema(ENTRY).parquet(*folders).collect(), key=lambda e: (e["seq"], e["attempt"])):
        last[e["run"], e["batch"]] = e
    taken = {tuple(r) for e in last.values() for r in e["replaces"]}
    counting = [e for e in last.values() if (e["run"], e["batch"], e["attempt"]) not in taken]
    return [e for e in counting if besides is None or e["run"] != besides.run or e["batch"] < besides.number]


def commit(spark: SparkSession, root: str, batch: Batch, tables: Sequence[str], spans: Sequence = (),
           base_rows: int | None = None, moves: int = 0, replaces: Sequence[Row] = ()) -> None:
    """Make the tables that this attempt has written count, in the place of the batches that it ``replaces``."""
    known = entries(spark, root)
    seq = max((e["seq"] for e in known), default=0) + 1
    place = max((e["place"] for e in replaces), default=seq)
    gone = [(e["run"], e["batch"], e["attempt"]) for e in replaces]
    row = (seq, batch.run, batch.number, batch.attempt, list(tables), [tuple(s) for s in spans], base_rows, moves, place, sum(e["weight"] for e in replaces) or 1, gone)
    folder = f"{root}/manifest/era={seq // ERA}"
    begun = any(n.startswith("part-") for n in _names(spark, folder))
    # What a new era repeats counts as it stands; what it leaves out, the last era has as well as its replacement.
    rows = [row] if begun else [*map(tuple, known), row]
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(folder)


def write(rows: DataFrame, root: str, table: str, batch: Batch, partition_by: Sequence[str] = (),
          also: Mapping[str, Column] | None = None) -> DataFrame:
    """Write a table of an attempt, to count from its commit on, and read it back for the steps in between.

    The number of rows, and ``also`` these aggregates, are observed while the rows are written, so
    nobody reads them again to know: ``batch.seen[table]`` and ``batch.seen[table.name]``.
    """
    path, observed = batch.folder(root, table), Observation()
    more = [c.alias(n) for n, c in (also or {}).items()]
    rows.observe(observed, F.count(F.lit(1)).alias("rows"), *more).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    if batch.seen is not None:
        found = observed.get
        batch.seen[table] = found["rows"]
        batch.seen.update({f"{table}.{n}": found[n] or 0 for n in also or {}})
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def read(spark: SparkSession, root: str, table: str, shape: str, among: Sequence[Row] | None = None) -> DataFrame:
    """A table of the batches that count (or ``among`` these), with run and batch; no rows where there is none."""
    some = entries(spark, root) if among is None else among
    paths = [Batch(e["run"], e["batch"], e["attempt"]).folder(root, table) for e in some if table in e["tables"]]
    whole = f"{shape}, run string, batch bigint, attempt string"
    if not paths:
        # Without the limit of none Spark would not know that it is empty, and plan joins and shuffles with it.
        return spark.createDataFrame([], whole).drop("attempt").limit(0)
    return spark.read.schema(whole).option("basePath", f"{root}/{table}").parquet(*paths).drop("attempt")
