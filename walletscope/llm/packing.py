"""Mixture-controlled packing by deficit round-robin.

Each source has a queue of tokens: its documents one after the other. A window is one
round: every queue earns its target share of the window, spends whole tokens of it and
carries the rest as its deficit into the next round; tokens that rounding leaves over go
to the queues with the largest deficits. So every window meets the targets to within a
token, and so does every run of windows.

Shares are set as whole tokens per cycle of ``CYCLE`` windows, after which every deficit
is back at zero. What a queue has spent before any window thus follows from the window's
number, and each task places its documents without asking another: only token counts per
part and source are gathered, and tokens are never shuffled. When a queue runs dry, the
others share its place from the next window on.

Defined results
- NULL text: empty, a document of its end token alone. NULL source: a queue of its own.
- Repeated rows are packed once each. Empty table: empty result. Extra columns are ignored.
- More sources than ``max_queues``: those with the most tokens have their own queue, the
  others share one, in which their tokens are interleaved by their numbers of tokens.
- Targets name sources, each of which has its own queue; sources without a target share
  what is left over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from walletscope.llm.word_tokens import coder
from walletscope.llm.worker import slices
from walletscope.plans.settle import settle

#: Windows after which all deficits return to zero.
CYCLE = 512
TOKENS = "doc_id long, source string, part int, start long, n_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, source string"


@dataclass
class Phase:
    """Windows from ``window`` on in which the same queues are served by the same shares."""

    window: int
    windows: int
    spent: np.ndarray            # tokens spent by each queue before the phase
    quanta: np.ndarray           # tokens of each queue per cycle; empty for a phase of one window
    grants: np.ndarray           # the grants of such a window
    _table: np.ndarray | None = field(default=None, repr=False)

    def table(self) -> np.ndarray:
        """Tokens spent by each queue before each window of a cycle, and after the last."""
        if self._table is None:
            self._table = round_robin(self.quanta, self.quanta.sum() // CYCLE) if len(self.quanta) else np.stack(
                [np.zeros_like(self.grants), self.grants])
        return self._table

    def before(self, window: np.ndarray) -> np.ndarray:
        """Tokens spent by each queue before each of the windows, (windows, queues)."""
        cycle, step = np.divmod(window - self.window, CYCLE)
        if not len(self.quanta):
            return self.spent + self.table()[window - self.window]
        return self.spent + cycle[:, None] * self.quanta + self.table()[step]

    def holding(self, queue: int, token: np.ndarray) -> np.ndarray:
        """The window that spends each of the tokens of a queue."""
        token = token - self.spent[queue]
        if not len(self.quanta):
            return np.full(len(token), self.window)
        cycle, rest = np.divmod(token, self.quanta[queue])
        return self.window + cycle * CYCLE + np.searchsorted(self.table()[:, queue], rest, "right") - 1


def round_robin(quanta: np.ndarray, width: int) -> np.ndarray:
    """Cumulative grants of the windows of one cycle.

    Deficits count in parts of 1/CYCLE token, so all sums are exact.
    """
    spent = np.zeros((CYCLE + 1, len(quanta)), np.int64)
    deficit = np.zeros(len(quanta), np.int64)
    for w in range(CYCLE):
        deficit += quanta
        grant = deficit // CYCLE
        deficit -= grant * CYCLE
        extra = np.argsort(-deficit, kind="stable")[:width - int(grant.sum())]
        grant[extra] += 1
        deficit[extra] -= CYCLE
        spent[w + 1] = spent[w] + grant
    return spent


def _quanta(weights: np.ndarray, width: int) -> np.ndarray:
    """Whole tokens per cycle in proportion to the weights, one at least for each queue."""
    total = width * CYCLE
    exact = weights / weights.sum() * (total - len(weights))
    quanta = 1 + np.floor(exact).astype(np.int64)
    left = total - int(quanta.sum())
    quanta[np.argsort(np.floor(exact) - exact, kind="stable")[:left]] += 1
    return quanta


def schedule(tokens: np.ndarray, weights: np.ndarray, width: int) -> list[Phase]:
    """The phases that spend all queues; a phase ends when a queue cannot pay its next grant."""
    phases: list[Phase] = []
    spent, window = np.zeros_like(tokens), 0
    while (active := np.flatnonzero(spent < tokens)).size:
        left = (tokens - spent)[active]
        quanta = np.zeros_like(tokens)
        quanta[active] = _quanta(np.maximum(weights[active], 1e-12), width)
        cycles = int((left // quanta[active]).min())
        table = round_robin(quanta[active], width)
        rest = left - cycles * quanta[active]
        steps = int(np.argmax((table > rest).any(axis=1))) - 1
        if windows := cycles * CYCLE + steps:
            phases.append(Phase(window, windows, spent, quanta, tokens[:0]))
            spent = phases[-1].before(np.array([window + windows]))[0]
            window += windows
        # the window in which a queue runs dry: the others take its place
        left = (tokens - spent)[active]
        if not left.any():
            break
        grant = np.minimum(np.diff(table, axis=0)[steps], left)
        short = min(width, int(left.sum())) - int(grant.sum())
        while short:
            room = left - grant
            more = np.minimum(-(-short * room // max(int(room.sum()), 1)), room)
            over = int(more.sum()) - short
            if over > 0:
                cut = np.cumsum(more[::-1])[::-1]
                more = more - np.clip(over - (cut - more), 0, more)
            grant, short = grant + more, short - int(more.sum())
        grants = np.zeros_like(tokens)
        grants[active] = grant
        phases.append(Phase(window, 1, spent, tokens[:0], grants))
        spent, window = spent + grants, window + 1
    return phases


def place(phases: list[Phase], queue: np.ndarray, first: np.ndarray, length: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where runs of a queue's tokens go: (run, start in run, length, window, offset in window)."""
    starts = np.array([p.window for p in phases])

    def window_of(token: np.ndarray) -> np.ndarray:
        found = np.empty(len(token), np.int64)
        for s in np.unique(queue):
            mine = np.flatnonzero(queue == s)
            phase = np.searchsorted([int(p.spent[s]) for p in phases], token[mine], "right") - 1
            for i in np.unique(phase):
                at = mine[phase == i]
                found[at] = phases[i].holding(s, token[at])
        return found

    low, high = window_of(first), window_of(first + length - 1)
    count = high - low + 1
    run = np.repeat(np.arange(len(first)), count)
    window = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    began, ended, ahead = (np.empty(len(run), np.int64) for _ in range(3))
    phase = np.searchsorted(starts, window, "right") - 1
    for i in np.unique(phase):
        mine = np.flatnonzero(phase == i)
        for at in np.array_split(mine, len(mine) * len(phases[0].spent) // (1 << 21) + 1):
            before, after = phases[i].before(window[at]), phases[i].before(window[at] + 1)
            own = queue[run[at]]
            rows = np.arange(len(at))
            began[at], ended[at] = before[rows, own], after[rows, own]
            granted = np.cumsum(after - before, axis=1)
            ahead[at] = granted[rows, own] - (ended[at] - began[at])
    a = np.maximum(began, first[run])
    b = np.minimum(ended, (first + length)[run])
    some = b > a
    return run[some], (a - first[run])[some], (b - a)[some], window[some], (ahead + a - began)[some]


def interleaved(counts: np.ndarray, leaf: int, token: np.ndarray) -> np.ndarray:
    """Places in a shared queue of tokens of one of its sources.

    The sources, of ``counts`` tokens, are halved by tokens again and again; the halves of a
    part take turns in proportion, so any run of places holds a source's share of it to
    within one token for each halving.
    """
    ends = np.concatenate([[0], np.cumsum(counts)])
    path: list[tuple[bool, int, int]] = []
    low, high = 0, len(counts)
    while high - low > 1:
        total = int(ends[high] - ends[low])
        cut = int(np.clip(np.searchsorted(ends, ends[low] + total // 2), low + 1, high - 1))
        low, high = (low, cut) if leaf < cut else (cut, high)
        path.append((low < cut, total, int(ends[high] - ends[low])))
    for first, total, own in reversed(path):
        if own >= 1 << 31:  # products beyond 64 bits
            token = token.astype(object)
        # of the first t places, the first half has floor(t * own / total), the second the others
        whole, rest = divmod(total, own)
        token = (token + 1) * whole - (-(token + 1) * rest // own) - 1 if first else token * whole + token * rest // own
    return token.astype(np.int64)


def spread(counts: np.ndarray, leaf: np.ndarray, first: np.ndarray, length: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a source's tokens as runs of its queue's: (run, start in run, length, first token in the queue).

    ``leaf`` is a source's number in the shared queue, -1 for one with its own.
    """
    own = np.flatnonzero(leaf < 0)
    found = [(own, np.zeros_like(own), length[own], first[own])]
    for i in np.unique(leaf[leaf >= 0]):
        mine = np.flatnonzero(leaf == i)
        n = length[mine]
        run = np.repeat(mine, n)
        start = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        at = interleaved(counts, i, first[run] + start)
        new = np.flatnonzero((np.diff(at, prepend=-2) != 1) | (start == 0))
        found.append((run[new], start[new], np.diff(new, append=len(at)), at[new]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _tokenize(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, spent = coder(path), {}
        for batch in batches:
            sources = batch.column("source").to_pylist()
            for part, ids in words.encode_all(batch.column("text")):
                starts = []
                for s, x in zip(sources[part], ids):
                    starts.append(spent.get(s, 0))
                    spent[s] = starts[-1] + len(x) + 1
                end = np.array([end_id], "<u4").tobytes()
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id")[part], "source": batch.column("source")[part],
                    "part": batch.column("part")[part], "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array([len(x) + 1 for x in ids], pa.int64()),
                    "ids": pa.array([x.astype("<u4").tobytes() + end for x in ids], pa.binary())})
    return run


def _placing(phases: list[Phase], shared: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(np.asarray(batch.column("n_tokens")), 1 << 20):
                some = batch.slice(part.start, part.stop - part.start)
                n = np.asarray(some.column("n_tokens"))
                run, before, long, first = spread(
                    shared, np.asarray(some.column("leaf")), np.asarray(some.column("first")), n)
                at, start, length, window, offset = place(phases, np.asarray(some.column("queue"))[run], first, long)
                at, start = run[at], before[at] + start
                ids = some.column("ids").to_pylist()
                cut = [ids[i][4 * a:4 * (a + k)] for i, a, k in zip(at.tolist(), start.tolist(), length.tolist())]
                rows = pa.array(at)
                yield pa.record_batch({
                    "doc_id": some.column("doc_id").take(rows), "start": start, "length": length,
                    "ids": pa.array(cut, pa.binary()), "doc_tokens": n[at], "sequence_id": window, "offset": offset,
                    "source": some.column("source").take(rows)})
    return run


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Documents as tokens, written once: ids, and the token count of their source in their part before them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.col("source").cast("string")
                       .alias("source"), F.spark_partition_id().alias("part"))
    return settle(rows.mapInArrow(_tokenize(tokenizer_path, end_id), TOKENS), "packing-tokens")


def pack(docs: DataFrame, tokenizer_path: str, targets: dict[str, float] | None = None, width: int = 2048,
         end_id: int = 1, max_queues: int = 256) -> DataFrame:
    """Pieces of documents with their place: one row per piece, ids as little-endian uint32.

    ``targets`` are token proportions by source; without them each source's share is its
    share of all tokens, so that all queues end together.
    """
    tokens = tokenize(docs, tokenizer_path, end_id)
    sums = settle(tokens.groupBy("source", "part").agg(F.sum("n_tokens").alias("n")), "packing-counts")
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    named = list(targets or {})
    order = [F.col("source").isin(named).desc() if named else F.desc("n"), F.desc("n"), F.col("source")]
    rows = by_source.orderBy(*order).collect()  # one for each source
    own = [r for r in rows if r["source"] in targets] if named else rows[:max_queues - 1]
    own_names = [r["source"] for r in own]
    apart = set(own_names)
    others = [r for r in rows if r["source"] not in apart]

    spark = tokens.sparkSession
    listed = spark.createDataFrame([(s, i, -1) for i, s in enumerate(own_names)]
                                   + [(r["source"], len(own), i) for i, r in enumerate(others)],
                                   "source string, queue long, leaf long")
    shared = np.array([r["n"] for r in others], np.int64)
    counts = np.array([r["n"] for r in own] + [shared.sum()], np.int64)
    if targets:
        weights = np.array([targets[s] for s in own_names] + [max(0.0, 1.0 - sum(targets.values()))])
    else:
        weights = counts.astype(float)
    phases = schedule(counts, weights, width)

    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = sums.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    bases = settle(based.join(listed, based["source"].eqNullSafe(listed["source"])).select(
        based["source"].alias("_s"), F.col("part").alias("_p"), "queue", "leaf", "base"), "packing-bases")
    placed = tokens.join(bases, tokens["source"].eqNullSafe(bases["_s"]) & (tokens["part"] == bases["_p"]))
    placed = placed.select("doc_id", "source", "queue", "leaf", (F.col("base") + F.col("start")).alias("first"),
                           "n_tokens", "ids")
    return placed.mapInArrow(_placing(phases, shared), PIECES)
