"""N-gram Jaccard join by T-occurrence search, and the groups that its links form.

Documents are sets of distinct word shingles; two link when the Jaccard similarity of
their sets reaches the threshold. Equal sets are one class, searched once.

Search. All shingles stand in one global order (their hashes). Of a set of n, whose links
need at least ceil(s * n) common shingles, only the first n - ceil(s * n) + 1 + k are
indexed: two linked sets then share T = k + 1 indexed shingles at least. Parts of the
hash range build the inverted lists of their shingles. A set's lists come together in one
task, which runs DivideSkip: the longest lists are set aside, the short ones are merged
through a heap, and what occurs often enough is looked up in the long ones by bisection.
Lists beyond ``list_limit`` stay where they are; each that a set is in lowers its T by one,
and the exact check that ends the search makes up for it. Nothing is left out by the limit:

- A set whose T falls to zero is *hard*. Its links to other sets are found from
  their side or by a merge with T = 1. Hard sets are then searched among themselves, with
  all of their shingles indexed.
- What is still hard has nearly all its shingles in long lists: large families of near
  copies. They go by their rarest shingles. In each list every member is checked against
  the list's least member, which joins a family without its pairs; then only members that
  still lie in different components are paired.

Links and classes give the connected components.

Shingles and sets are known by 64-bit hashes; a collision among n of them has a chance of
about n * n / 2**65.

Defined results
- NULL or blank text: empty set, 0 shingles, linked with nothing. Equal sets are linked.
- NULL id: its row is a document; a component's name is its least id that is not NULL.
- Repeated rows: equal sets. Rows of one id with different texts are documents of their own.
- Ties: a group keeps its least id. Empty table: empty result.
- Extra columns are ignored by ``join`` and pass through ``keep_one``.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from walletscope.llm.components import components
from walletscope.llm.shingles import fingerprint, per_text, signed
from walletscope.plans.settle import settle


@dataclass(frozen=True)
class Similarity:
    """``percent`` of 100 is the least Jaccard similarity; ``words`` the length of a shingle."""

    words: int = 5
    percent: int = 80
    list_limit: int = 64       # longest inverted list that is sent to its sets
    part_tokens: int = 1 << 20  # indexed shingles of a part, on average

    def needed(self, n: np.ndarray) -> np.ndarray:
        """Common shingles that any link of a set of n has, and the size of its smallest partner."""
        return -(-self.percent * n // 100)

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return n - self.needed(n) + 1

    def extra(self, n: np.ndarray) -> np.ndarray:
        """k: shingles indexed beyond the prefix. It never falls as n grows."""
        return np.minimum(8 + n // 16, n - self.prefix(n))

    def indexed(self, n: np.ndarray) -> np.ndarray:
        return self.prefix(n) + self.extra(n)

    def occurrences(self, n: np.ndarray) -> np.ndarray:
        """T when the index holds ``indexed``: what the smallest partner allows."""
        return self.extra(self.needed(n)) + 1

    def alone(self, n: np.ndarray) -> np.ndarray:
        """Whether a set is too small to link with another one."""
        return self.percent * (n + 1) > 100 * n

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent


SETS = "doc_id long, cls long, n long, indexed binary"


def document_sets(docs: DataFrame, how: Similarity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class, size and indexed shingles; these once per class and stretch of documents."""
    def make(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        names = [fingerprint(s) for s in sets]
        n = np.array([len(s) for s in sets], np.int64)
        take, alone = how.indexed(n), how.alone(n)
        first: set[int] = set()
        indexed = []
        for name, s, k, single in zip(names, sets, take.tolist(), alone.tolist()):
            indexed.append(None if single or name in first else s[:k].tobytes())
            first.add(name)
        return pa.record_batch({"doc_id": ids, "cls": signed(names), "n": n, "indexed": pa.array(indexed, pa.binary())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return settle(rows.mapInArrow(per_text(make, how.words, 1, 0), SETS), "jaccard-sets")


# --- inverted lists, by parts of the hash range ---------------------------------------

_PART = "part long, tokens binary, owners binary, cls binary, n binary, long_of binary, long_sizes binary"
_LISTS = "target long, of binary, length binary, members binary, sizes binary, long_of binary, long_sizes binary"


def _flat(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _to_parts(parts: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cut the indexed shingles of each batch of sets by parts of the hash range.

    A class that several stretches brought into a batch counts once. A shingle that more
    than ``limit`` sets of a batch have is in a long list for certain.
    Of its sets, as many go to its part as show that; the others are told at once that one
    of their lists is long, so a shingle that very many documents share fills no task.
    """
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(np.sort(np.unique(np.asarray(batch.column("cls")), return_index=True)[1])))
            raw = batch.column("indexed").to_pylist()
            cls, n = np.asarray(batch.column("cls")), np.asarray(batch.column("n"))
            tokens = np.frombuffer(b"".join(raw), np.uint64)
            owners = np.repeat(np.arange(len(raw), dtype=np.uint32), [len(r) // 8 for r in raw])
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order]
            starts = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else np.zeros(0, int)
            nth = np.arange(len(tokens)) - np.repeat(starts, np.diff(np.append(starts, len(tokens))))
            told, sent = owners[nth > limit], nth <= limit
            tokens, owners = tokens[sent], owners[sent]
            part = np.searchsorted(edges, tokens, "right")
            told_part = cls[told].view(np.uint64) % np.uint64(parts)
            rows = []
            for p in np.union1d(part, told_part.astype(np.int64)).tolist():
                a, b = np.searchsorted(part, [p, p + 1])
                used, local = np.unique(owners[a:b], return_inverse=True)
                marked = told[told_part == p] if len(told) else told
                rows.append((p, tokens[a:b].tobytes(), local.astype("<u4").tobytes(), cls[used].tobytes(),
                             n[used].tobytes(), cls[marked].tobytes(), n[marked].tobytes()))
            if rows:
                columns = list(zip(*rows))
                yield pa.record_batch([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                                      ["part", "tokens", "owners", "cls", "n", "long_of", "long_sizes"])
    return run


def _to_lists(how: Similarity, targets: int) -> Callable[[pa.Table], pa.Table]:
    """The inverted lists of a part, sent to the tasks of their members."""
    def run(part: pa.Table) -> pa.Table:
        counts = np.array([len(x) // 8 for x in part["cls"].to_pylist()])
        sizes_of = np.array([len(x) // 4 for x in part["owners"].to_pylist()])
        owner = _flat(part["owners"], "<u4").astype(np.int64) + np.repeat(np.cumsum(counts) - counts, sizes_of)
        token = _flat(part["tokens"], np.uint64)
        cls, n = _flat(part["cls"], np.int64)[owner], _flat(part["n"], np.int64)[owner]
        order = np.lexsort((cls, token))
        token, cls, n = token[order], cls[order], n[order]
        if len(token):  # a class met in several stretches counts once
            new = np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]))
            token, cls, n = token[new], cls[new], n[new]
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        length = np.diff(np.append(starts, len(token)))

        long_at = _ranges(starts[length > how.list_limit], length[length > how.list_limit])
        long_of = np.concatenate([cls[long_at], _flat(part["long_of"], np.int64)])
        long_sizes = np.concatenate([n[long_at], _flat(part["long_sizes"], np.int64)])
        of, at, listed, member = [], [], [], []
        for size in np.unique(length[(length > 1) & (length <= how.list_limit)]):
            rows = starts[length == size][:, None] + np.arange(size)
            high, low = np.tril_indices(size, -1)  # each set gets the members before it
            x, y = rows[:, high].ravel(), rows[:, low].ravel()
            near = np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * how.percent
            of.append(cls[x[near]])
            at.append(n[x[near]])
            listed.append(np.repeat(rows[:, 0], len(high))[near])
            member.append(cls[y[near]])
        of, at, listed, member = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (of, at, listed, member))
        order = np.lexsort((member, listed, of))
        of, at, listed, member = of[order], at[order], listed[order], member[order]
        new = np.append(True, (of[1:] != of[:-1]) | (listed[1:] != listed[:-1])) if len(of) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(of)))
        target, long_target = of[first].view(np.uint64) % np.uint64(targets), long_of.view(np.uint64) % np.uint64(targets)
        rows = []
        for t in np.union1d(target, long_target):
            here, there = np.flatnonzero(target == t), long_target == t
            rows.append((int(t), of[first[here]].tobytes(), many[here].astype("<u4").tobytes(),
                         member[_ranges(first[here], many[here])].tobytes(), at[first[here]].tobytes(),
                         long_of[there].tobytes(), long_sizes[there].tobytes()))
        columns = list(zip(*rows)) if rows else [()] * 7
        return pa.table([pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
                        names=["target", "of", "length", "members", "sizes", "long_of", "long_sizes"])
    return run


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


# --- T-occurrence search -------------------------------------------------------------

def divide_skip(lists: list[list[int]], t: int) -> list[int]:
    """The members of at least t of the rising lists."""
    if len(lists) < t:
        return []
    lists = sorted(lists, key=len, reverse=True)
    apart = min(t - 1, int(t / (0.01 * len(lists[0]).bit_length() + 1)))
    long, short = lists[:apart], lists[apart:]
    found = []
    last, seen = None, 0
    for member in (*heapq.merge(*short), None):
        if member == last:
            seen += 1
            continue
        if seen >= t - apart and last is not None:
            for i, probed in enumerate(long):
                if seen >= t or seen + len(long) - i < t:
                    break
                at = bisect_left(probed, last)
                seen += at < len(probed) and probed[at] == last
            if seen >= t:
                found.append(last)
        last, seen = member, 1
    return found


def _search(how: Similarity, whole: bool) -> Callable[[pa.Table], pa.Table]:
    """Candidate pairs (x, y) of the sets of a task; a hard set is also a row of its own, with y NULL."""
    def run(got: pa.Table) -> pa.Table:
        of, size = _flat(got["of"], np.int64), _flat(got["sizes"], np.int64)
        length, members = _flat(got["length"], "<u4").astype(np.int64), _flat(got["members"], np.int64)
        ends = np.cumsum(length)
        long_of, long_size = _flat(got["long_of"], np.int64), _flat(got["long_sizes"], np.int64)
        unsent = Counter(long_of.tolist())
        sizes = dict(zip(of.tolist(), size.tolist())) | dict(zip(long_of.tolist(), long_size.tolist()))
        need = {}
        if sizes:
            n = np.fromiter(sizes.values(), np.int64)
            need = dict(zip(sizes, (how.needed(n) if whole else how.occurrences(n)).tolist()))
        xs: list[int] = []
        ys: list[int | None] = []
        hard = [x for x, k in unsent.items() if need[x] - k <= 0]
        xs += hard
        ys += [None] * len(hard)
        order = np.argsort(of, kind="stable")
        x = of[order]
        starts = np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else x
        for a, b in zip(starts, [*starts[1:], len(x)]):
            name = int(x[a])
            t = max(1, need[name] - unsent[name])
            if b - a < t:
                continue
            lists = [members[ends[i] - length[i]:ends[i]].tolist() for i in order[a:b]]
            found = divide_skip(lists, t)
            xs += [name] * len(found)
            ys += found
        return pa.table({"x": pa.array(xs, pa.int64()), "y": pa.array(ys, pa.int64())})
    return run


def search(sets: DataFrame, how: Similarity, whole: bool) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (x, y) and hard sets (cls) among ``sets`` (cls, n, indexed).

    ``whole`` says that the index holds all shingles of each set.
    """
    spark = sets.sparkSession
    total = sets.agg(F.sum(F.octet_length("indexed"))).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, total // 8 // how.part_tokens)
    index = sets.select("cls", "n", "indexed").filter("indexed IS NOT NULL").mapInArrow(_to_parts(parts, how.list_limit), _PART)
    lists = index.groupBy("part").applyInArrow(_to_lists(how, parts), _LISTS)
    found = settle(lists.groupBy("target").applyInArrow(_search(how, whole), "x long, y long"), "jaccard-candidates")
    return found.filter("y IS NOT NULL"), found.filter("y IS NULL").select(F.col("x").alias("cls"))


# --- sets of some classes, and the exact check ------------------------------------------

def whole_sets(docs: DataFrame, known: DataFrame, wanted: DataFrame, how: Similarity, id_col: str,
               text_col: str) -> DataFrame:
    """(cls, n, indexed) of the ``wanted`` classes, with all shingles, from a document of each."""
    member = known.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))

    def make(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        return pa.record_batch({"cls": signed([fingerprint(s) for s in sets]),
                                "n": np.array([len(s) for s in sets], np.int64),
                                "indexed": pa.array([s.tobytes() for s in sets], pa.binary())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ids = member.select(F.col("doc_id").alias("_id")).distinct()
    some = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    made = some.mapInArrow(per_text(make, how.words, 1, 0), "cls long, n long, indexed binary")
    # rows that share an id may bring other classes along
    return settle(made.join(wanted, "cls", "left_semi").dropDuplicates(["cls"]), "jaccard-whole-sets")


def _linked(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for s, t in zip(batch.column("s"), batch.column("t")):
                a, b = np.frombuffer(s.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.uint64)
                if len(a) > len(b):
                    a, b = b, a
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                common = int((b[at] == a).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.record_batch({"a": batch.column("x").filter(mask), "b": batch.column("y").filter(mask)})
    return run


def verify(pairs: DataFrame, sets: DataFrame, how: Similarity) -> DataFrame:
    """The pairs (x, y) whose whole sets are similar, as edges (a, b)."""
    left = sets.select(F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("indexed").alias("s"))
    right = sets.select(F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("indexed").alias("t"))
    slim = left.drop("s"), right.drop("t")
    fit = pairs.select("x", "y").distinct().join(slim[0], "x").join(slim[1], "y").filter(
        how.sizes_fit(F.col("nx"), F.col("ny"))).select("x", "y")
    both = fit.join(left.drop("nx"), "x").join(right.drop("ny"), "y")
    return settle(both.mapInArrow(_linked(how.percent), "a long, b long"), "jaccard-links")


# --- families: sets with nearly all shingles in long lists --------------------------------

def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, len(batch), 500):
            some = batch.slice(first, 500)
            raw = some.column("indexed").to_pylist()
            many = np.array([len(r) // 8 for r in raw], np.int64)
            yield pa.record_batch({
                "cls": np.repeat(np.asarray(some.column("cls")), many), "n": np.repeat(np.asarray(some.column("n")), many),
                "token": np.frombuffer(b"".join(raw), np.int64)})


def families(sets: DataFrame, links: DataFrame, how: Similarity) -> DataFrame:
    """The given links, and all others that are needed to connect the linked among ``sets``.

    Prefixes by rarity: two linked sets share one of their rarest n - ceil(s * n) + 1
    shingles, and from where the first of them stands in both follows how many they can
    share. First every member of a list is checked against a central one, whose shingles
    most sets have; then those outside the list's largest component against one of them.
    In the end, members that still lie in different components are checked against each
    other, where sizes and places allow that they are similar.
    """
    tokens = sets.mapInArrow(_shingles, "cls long, n long, token long")
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    own = Window.partitionBy("cls")
    # shingles of one set alone come first in the order; they shorten the prefix
    shared = tokens.join(counts, "token").select(
        "cls", "n", "token", (F.row_number().over(own.orderBy("f", "token")) + F.col("n") - F.count(F.lit(1)).over(own)).alias("at"),
        (F.sum("f").over(own) / F.col("n")).alias("central"))
    prefix = settle(shared.filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * how.percent / 100) + 1), "jaccard-families")

    def near(n: Column, i: Column, m: Column, j: Column) -> Column:
        """Whether sets of n and m whose *first* common shingle stands at i and j can be similar."""
        most = F.least(n - i, m - j) + 1
        return how.sizes_fit(n, m) & (most * (100 + how.percent) >= (n + m) * how.percent)

    def named(found: DataFrame) -> DataFrame:
        """Members of lists with their components, of lists that hold more than one."""
        joined = components(found).withColumnRenamed("vertex", "cls")
        rows = prefix.join(joined, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        sizes = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("m"))
        largest = sizes.groupBy("token").agg(F.max_by("component", F.struct("m", "component")).alias("largest"),
                                             F.count(F.lit(1)).alias("parts")).filter("parts > 1").drop("parts")
        return settle(rows.join(largest, "token"), "jaccard-mixed")

    def starred(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        """Links of the members of each list with the most central of ``chosen``."""
        pivot = chosen.groupBy("token").agg(F.max(F.struct("central", "cls", "n", "at", "component")).alias("p"))
        pairs = rows.join(pivot, "token").filter(
            (F.col("component") != F.col("p.component")) & near(F.col("n"), F.col("at"), F.col("p.n"), F.col("p.at")))
        return verify(pairs.select(_pair(F.col("p.cls"), F.col("cls"))).select("pair.*").distinct(), sets, how)

    found = links
    mixed = named(found)
    found = found.unionByName(starred(mixed, mixed))
    mixed = named(found)
    found = found.unionByName(starred(mixed, mixed.filter("component <> largest")))
    mixed = named(found)

    # sizes and places at which members of a list can be similar at all, before any members meet
    place = mixed.select("token", "n", "at").distinct()
    x, y = (place.select("token", F.col("n").alias(f"n{v}"), F.col("at").alias(f"i{v}")) for v in "xy")
    places = x.join(y, "token").filter(near(F.col("nx"), F.col("ix"), F.col("ny"), F.col("iy")))
    few = mixed.filter("component <> largest").select(
        "token", F.col("cls").alias("x"), F.col("n").alias("nx"), F.col("at").alias("ix"), F.col("component").alias("cx"))
    other = mixed.select("token", F.col("cls").alias("y"), F.col("n").alias("ny"), F.col("at").alias("iy"),
                         F.col("component").alias("cy"))
    pairs = few.join(places, ["token", "nx", "ix"]).join(other, ["token", "ny", "iy"]).filter("cx <> cy")
    pairs = pairs.select(_pair(F.col("x"), F.col("y"))).select("pair.*").distinct()
    return found.unionByName(verify(pairs, sets, how))


def _pair(a: Column, b: Column) -> Column:
    return F.struct(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).alias("pair")


# --- the join ---------------------------------------------------------------------------

def links(docs: DataFrame, how: Similarity, id_col: str = "doc_id", text_col: str = "text"
          ) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, cls, n, ...) and links between classes (a, b) that give all components."""
    known = document_sets(docs, how, id_col, text_col)
    pairs, hard = search(known, how, whole=False)
    wanted = settle(pairs.select(F.col("x").alias("cls")).union(pairs.select("y")).union(hard).distinct(),
                    "jaccard-wanted")
    sets = whole_sets(docs, known, wanted, how, id_col, text_col)
    hard_sets = sets.join(hard, "cls", "left_semi")
    hard_pairs, stuck = search(hard_sets, how, whole=True)
    found = verify(pairs.unionByName(hard_pairs), sets, how)
    if not stuck.isEmpty():
        found = families(settle(sets.join(stuck, "cls", "left_semi"), "jaccard-stuck"), found, how)
    return known.select("doc_id", "cls", "n"), found


def join(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id, the least id among the documents it is linked with in any number of steps."""
    known, found = links(docs, how, id_col, text_col)
    classes = known.groupBy("cls").agg(F.min("doc_id").alias("least"))
    linked = components(found).withColumnRenamed("vertex", "cls")
    lowest = linked.join(classes, "cls").groupBy("component").agg(F.min("least").alias("lowest"))
    moved = linked.join(lowest, "component").select("cls", "lowest")
    named = classes.join(moved, "cls", "left").select("cls", F.coalesce("lowest", "least").alias("component_id"))
    empty = F.col("n") == 0
    return known.join(named, "cls").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the least id of each group. Rows without an id stay, as do repeated rows of an id that stays.

    Only the ids that go are joined, normally few of all.
    """
    grouped = join(docs, how, id_col, text_col).filter("doc_id IS NOT NULL")
    gone = grouped.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"))
    gone = settle(gone.filter("NOT stays").select(F.col("doc_id").alias("_id")), "jaccard-gone")
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).cast("long").alias("_of"))
    return rows.join(gone, F.col("_of") == F.col("_id"), "left_anti").select("_doc.*")
