"""Near duplicates by b-bit MinHash, confirmed on whole shingle sets, and the groups that they form.

Documents are sets of distinct word shingles; two link when the Jaccard similarity of their
sets reaches the threshold. Equal sets are one class, known by a 128-bit name.

1. One pass over the texts takes ``bands * rows`` minima of each class. Bands of whole minima
   give the keys of its buckets. Of each minimum only the low ``bits`` are kept, packed by bit
   planes into the signature.
2. In each bucket every class meets one pivot, the class that shares most buckets with others.
   Signatures tell which meetings are worth a look: the share of equal low bits, counted
   with bit counts and corrected for chance collisions, estimates the similarity. What lies six
   standard deviations below the threshold is left out. The best meeting of each class is
   confirmed on the whole sets. Families of copies come together here without their pairs.
3. Buckets that still hold several components are cut into cells of at most some hundred
   classes, so that any two classes of different components share a cell of the bucket.
   Cells estimate all their pairs with bit counts, each pair in the first bucket
   that it shares, and the classes of worthwhile pairs are confirmed cell by cell, by the product of
   their shingle matrices. Only links that join components leave a cell.

A link at the threshold shares no bucket with a chance of (1 - s ** rows) ** bands, 5e-8 for
0.8, and is underestimated by six standard deviations with one of 1e-9. Nothing else is left
out: there are no limits on buckets, candidates or partners. A bucket of m classes of which o lie
outside its largest component costs m * o estimates, in cells of bounded size.

Defined results
- NULL or blank text: empty set, 0 shingles, linked with nothing. Equal sets are linked.
- NULL id: its row is a document; a component's name is its least id that is not NULL.
- Very long text: its whole set takes part; one task holds it. Repeated rows: equal sets.
- Ties: a group keeps its least id. Empty table: empty result.
- Extra columns are ignored by ``groups`` and pass through ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from walletscope.llm.components import components
from walletscope.llm.shingles import STRETCH, mix, shingle_sets
from walletscope.llm.worker import text_slices
from walletscope.plans.settle import settle

_ODD = np.uint64(0x9E3779B97F4A7C15)
Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Sketch:
    """``percent`` of 100 is the least Jaccard similarity; ``words`` the length of a shingle."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    bits: int = 4      # low bits kept of a minimum
    cell: int = 128    # classes on a side of a cell, on average
    sigmas: float = 6.0
    seed: int = 7

    @property
    def size(self) -> int:
        """Minima of a sketch, a multiple of 64."""
        if self.bands * self.rows % 64:
            raise ValueError("bands * rows must be a multiple of 64")
        return self.bands * self.rows

    @property
    def floor(self) -> float:
        """The least estimate that is worth a look."""
        chance = 0.5 ** self.bits
        equal = self.percent / 100 * (1 - chance) + chance
        return self.percent / 100 - self.sigmas * math.sqrt(equal * (1 - equal) / self.size) / (1 - chance)

    def linkable(self, n: int) -> bool:
        """Whether a set of n can link with another one."""
        return self.percent * (n + 1) <= 100 * n


# --- sketches -----------------------------------------------------------------------------------

def minima(sets: list[np.ndarray], how: Sketch) -> np.ndarray:
    """A row of mixed minima for each set, which must not be empty."""
    rng = np.random.default_rng(how.seed)
    turns = rng.integers(0, 1 << 63, (2, how.size), np.int64).astype(np.uint64)
    shingles = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least, room = np.empty((how.size, len(sets)), np.uint64), np.empty_like(shingles)
    for i, (flip, spread) in enumerate(turns.T):
        np.bitwise_xor(shingles, flip, out=room)
        np.multiply(room, spread << np.uint64(1) | np.uint64(1), out=room)
        np.minimum.reduceat(room, starts, out=least[i])
    return mix(np.ascontiguousarray(least.T))


def band_keys(least: np.ndarray, how: Sketch) -> np.ndarray:
    keys = np.tile(np.arange(1, how.bands + 1, dtype=np.uint64), (len(least), 1))
    for row in range(how.rows):
        keys = mix(keys * _ODD + least[:, row::how.rows])
    return keys


def signatures(least: np.ndarray, how: Sketch) -> np.ndarray:
    """The low bits of the minima, plane by plane."""
    planes = [(least >> np.uint64(p) & np.uint64(1)).astype(np.uint8) for p in range(how.bits)]
    return np.ascontiguousarray(np.hstack([np.packbits(p, axis=1) for p in planes])).view(np.uint64)


def estimates(left: np.ndarray, right: np.ndarray, how: Sketch) -> np.ndarray:
    """Estimated similarities of signatures, broadcast over all but the last axis."""
    width = how.size // 64
    unequal = np.zeros(np.broadcast_shapes(left.shape[:-1], right.shape[:-1]), np.int64)
    for word in range(width):
        differ = left[..., word] ^ right[..., word]
        for plane in range(1, how.bits):
            differ = differ | left[..., plane * width + word] ^ right[..., plane * width + word]
        unequal += np.bitwise_count(differ)
    chance = 0.5 ** how.bits
    return (1 - unequal / how.size - chance) / (1 - chance)


_ROWS = "doc_id bigint, row_key bigint, name binary, n bigint, sig binary, keys binary"


def _sketches(how: Sketch) -> Callable[[Batches], Batches]:
    """Names and sizes of all sets, sketches of each class once per stretch."""
    def one(ids: pa.Array, row_keys: pa.Array, texts: list[str]) -> pa.RecordBatch:
        sets = shingle_sets(texts, how.words)
        names = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        first = {name: i for i, name in reversed(list(enumerate(names))) if name}
        chosen = sorted(i for i in first.values() if how.linkable(len(sets[i])))
        sig: list[bytes | None] = [None] * len(sets)
        keys = list(sig)
        if chosen:
            least = minima([sets[i] for i in chosen], how)
            for i, s, k in zip(chosen, signatures(least, how), band_keys(least, how)):
                sig[i], keys[i] = s.tobytes(), k.tobytes()
        return pa.record_batch({"doc_id": ids, "row_key": row_keys, "name": pa.array(names, pa.binary()),
                                "n": pa.array([len(s) for s in sets], pa.int64()), "sig": pa.array(sig, pa.binary()),
                                "keys": pa.array(keys, pa.binary())})

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part, texts in text_slices(batch.column(2), STRETCH):
                yield one(batch.column(0)[part], batch.column(1)[part], texts)
    return run


def _unpacked(how: Sketch) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield pa.record_batch({
                "c": np.repeat(np.asarray(batch.column(0)), how.bands),
                "band": np.tile(np.arange(how.bands, dtype=np.int32), batch.num_rows), "key": keys})
    return run


# --- cells --------------------------------------------------------------------------------------

def _by_cell(batches: Batches) -> Iterator[pa.Table]:
    """The rows of each value of the first column, which come together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        cells = np.asarray(batch.column(0))
        edges = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            if held and held[0].column(0)[0].as_py() != cells[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Rows that meet: those of side 0 and 1, or those of side 2 among themselves."""
    alone = bool((side == 2).any())
    return (np.flatnonzero(side == 2),) * 2 + (True,) if alone else (np.flatnonzero(side == 0), np.flatnonzero(side == 1), False)


def _worthwhile(how: Sketch) -> Callable[[Batches], Batches]:
    """Of each cell, the classes with a worthwhile partner in another component that no earlier bucket brings."""
    def run(batches: Batches) -> Batches:
        for rows in _by_cell(batches):
            side, band, c, comp = (rows.column(i).to_numpy() for i in range(1, 5))
            sig, keys = (np.frombuffer(b"".join(rows.column(i).to_pylist()), np.uint64).reshape(len(c), -1) for i in (5, 6))
            left, right, alone = _sides(side)
            good = (estimates(sig[left][:, None], sig[right][None], how) >= how.floor) & (comp[left][:, None] != comp[right])
            if alone:
                good = np.triu(good, 1)
            i, j = np.nonzero(good)
            if not len(i):
                continue
            i, j = left[i], right[j]
            new = np.ones(len(i), bool)
            for earlier in range(int(band[0])):
                new &= keys[i, earlier] != keys[j, earlier]
            met = np.unique(np.concatenate([i[new], j[new]]))
            if len(met):
                yield pa.record_batch({"cell": rows.column(0).to_numpy()[met], "side": side[met], "c": c[met], "comp": comp[met]})
    return run


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of each set of one side with each of the other."""
    if len(sets) == 2:
        return np.array([[len(np.intersect1d(*sets, assume_unique=True))]])
    _, at, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = held > 1
    column = np.cumsum(shared) - 1
    owner, at = owner[shared[at]], column[at[shared[at]]]
    total, width = np.zeros((len(left), len(right)), np.float32), 8192
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(at, [low, low + width])
        ones = np.zeros((len(sets), width), np.float32)
        ones[owner[a:b], at[a:b] - low] = 1
        total += ones[left] @ ones[right].T
    return total.astype(np.int64)


def _confirmed(how: Sketch) -> Callable[[Batches], Batches]:
    """Links between the classes of each cell that join components, on their whole sets."""
    def links(side: list[int], c: list[int], comp: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
        left, right, alone = _sides(np.array(side))
        if not len(left) or not len(right) or len(sets) < 2:
            return []
        if alone and len(sets) == 2:
            left, right, alone = left[:1], right[1:], False
        common = _common(sets, left, right)
        n = np.array([len(s) for s in sets])
        linked = 100 * common >= how.percent * (n[left][:, None] + n[right] - common)
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(linked, 1) if alone else linked))):
            a, b = left[i], right[j]
            x, y = top(comp[a]), top(comp[b])
            if x != y:
                root[x] = y
                found.append((c[a], c[b]))
        return found

    def run(batches: Batches) -> Batches:
        now, rows = None, ([], [], [], [])

        def done() -> pa.RecordBatch | None:
            pairs = links(*rows) if rows[0] else []
            for r in rows:
                r.clear()
            return pa.record_batch({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

        for batch in batches:
            for cell, side, c, comp, shingles in zip(*(column.to_pylist() for column in batch.columns)):
                if cell != now:
                    yield done()
                    now = cell
                for r, value in zip(rows, (side, c, comp, np.frombuffer(shingles, np.uint64))):
                    r.append(value)
        yield done()
    return run


# --- the search -----------------------------------------------------------------------------------

def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def _perhaps(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose 64-bit hash ``key`` is not in ``wanted``, and with all that are.

    The wanted hashes mark bits of a map of a fixed size, 8 MB, which may be broadcast. With
    very many of them most bits are set, and most rows stay.
    """
    bit = F.col(key).bitwiseAND(F.lit((1 << 26) - 1))
    marked = wanted.groupBy(F.shiftright(bit, 15).alias("_part")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(F.lit(32767))).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(bit.bitwiseAND(F.lit(32767)), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = rows.withColumn("_part", F.shiftright(bit, 15)).join(F.broadcast(marked), "_part")
    set_bit = met.withColumns({"_byte": byte, "_nth": bit.bitwiseAND(F.lit(7)).cast("int")})
    return set_bit.where(F.expr("(_byte >> _nth) & 1 = 1")).drop("_part", "_bits", "_byte", "_nth")


def _whole_sets(docs: DataFrame, known: DataFrame, how: Sketch, id_col: str, text_col: str) -> DataFrame:
    """c, shingles: whole sets of the classes that share a bucket. One document of each class lends its text."""
    wanted = known.select("c", F.col("row_key").alias("_key"))
    rows = docs.select(_row_key(id_col, text_col).alias("_key"), F.col(text_col).alias("text"))
    texts = _perhaps(rows, "_key", wanted.select("_key")).join(wanted, "_key").groupBy("c").agg(F.first("text").alias("text"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part, some in text_slices(batch.column(1), STRETCH):
                sets = [x.tobytes() for x in shingle_sets(some, how.words)]
                yield pa.record_batch({"c": batch.column(0)[part], "shingles": pa.array(sets, pa.binary())})

    return settle(texts.mapInArrow(run, "c bigint, shingles binary"), "minhash-sets")


def _confirm(cells: DataFrame, sets: DataFrame, how: Sketch) -> DataFrame:
    """Links (a, b) inside ``cells`` (cell, side, c, comp)."""
    met = cells.join(sets, "c").select("cell", "side", "c", "comp", "shingles")
    return met.repartition("cell").sortWithinPartitions("cell").mapInArrow(_confirmed(how), "a bigint, b bigint")


def _deal(count: Column, how: Sketch) -> Column:
    return F.ceil(count / how.cell).cast("int")


def _pivot_cells(members: DataFrame, known: DataFrame, how: Sketch) -> DataFrame:
    """Each class with the best of its buckets' pivots, in cells."""
    pivots = (members.join(known.select("c", "score"), "c").groupBy("key")
              .agg(F.max(F.struct("score", (-F.col("c")).alias("c"))).alias("_p"))
              .select("key", (-F.col("_p.c")).alias("p"), F.col("_p.score").alias("p_score")))
    pairs = members.join(pivots, "key").where("c <> p").select("c", "p", "p_score").distinct()
    sigs = known.select("c", "sig")
    both = pairs.join(sigs, "c").join(sigs.select(F.col("c").alias("p"), F.col("sig").alias("p_sig")), "p")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for i in (3, 4))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(estimates(a, b, how))], ["c", "p", "p_score", "like"])

    met = both.select("c", "p", "p_score", "sig", "p_sig").mapInArrow(run, "c bigint, p bigint, p_score bigint, like double")
    sure = F.least("like", F.lit(how.percent / 100 + 0.05))
    best = settle(met.where(F.col("like") >= how.floor).groupBy("c").agg(F.max(F.struct(sure, "p_score", "p")).alias("_b"))
                  .select("c", "_b.p"), "minhash-pivots")
    many = best.groupBy("p").count()
    dealt = best.join(many, "p").select("c", "p", F.pmod(F.xxhash64("c"), _deal(F.col("count"), how)).alias("_block"))
    cell = F.xxhash64("p", "_block")
    ones = dealt.select(cell.alias("cell"), F.lit(1).alias("side"), "c", F.col("c").alias("comp"))
    zeros = dealt.select(cell.alias("cell"), F.lit(0).alias("side"), F.col("p").alias("c"), F.col("p").alias("comp")).distinct()
    return settle(ones.unionByName(zeros), "minhash-cells")


def _open_cells(members: DataFrame, known: DataFrame, comps: DataFrame, how: Sketch) -> DataFrame:
    """Cells of the buckets that hold several components, with the classes worth a confirmation.

    A bucket's largest component is its core. Classes outside it meet the core and each other.
    """
    placed = settle(members.join(comps.withColumnRenamed("vertex", "c"), "c", "left").select(
        "band", "key", "c", F.coalesce("component", "c").alias("comp")), "minhash-placed")
    parts = placed.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("k"))
    several = (parts.groupBy("key").agg(F.max(F.struct("k", "comp")).alias("_c"), F.sum("k").alias("_all"), F.count(F.lit(1)).alias("_parts"))
               .where("_parts > 1").select("key", F.col("_c.comp").alias("core"), _deal(F.col("_c.k"), how).alias("_in"),
                                           _deal(F.col("_all") - F.col("_c.k"), how).alias("_out")))
    rows = placed.join(several, "key")
    inside = F.col("comp") == F.col("core")
    rows = rows.withColumn("_mine", F.pmod(F.xxhash64("c"), F.when(inside, F.col("_in")).otherwise(F.col("_out"))).cast("int"))

    def meet(kind: str, i: Column, j: Column, side) -> Column:
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.cast("int").alias("side"))

    outs, ins, mine = F.sequence(F.lit(0), F.col("_out") - 1), F.sequence(F.lit(0), F.col("_in") - 1), F.col("_mine")
    cross = F.when(inside, F.transform(outs, lambda o: meet("x", o, mine, F.lit(0)))).otherwise(
        F.transform(ins, lambda i: meet("x", mine, i, F.lit(1))))
    own = F.transform(F.when(~inside, outs).otherwise(F.array().cast("array<int>")), lambda o: meet(
        "o", F.least(mine, o), F.greatest(mine, o), F.when(mine == o, 2).when(mine < o, 0).otherwise(1)))
    spread = rows.select("band", "key", "c", "comp", F.explode(F.concat(cross, own)).alias("_m")).select(
        F.xxhash64("key", "_m.kind", "_m.i", "_m.j").alias("cell"), "_m.side", "band", "c", "comp")
    full = spread.join(known.select("c", "sig", "keys"), "c").select("cell", "side", "band", "c", "comp", "sig", "keys")
    return settle(full.repartition("cell").sortWithinPartitions("cell").mapInArrow(
        _worthwhile(how), "cell bigint, side int, c bigint, comp bigint"), "minhash-open")


def groups(docs: DataFrame, how: Sketch = Sketch(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id, the least id among the documents it is linked with in any number of steps."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), _row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    rows = settle(given.mapInArrow(_sketches(how), _ROWS), "minhash-rows")
    classes = rows.where("name IS NOT NULL").groupBy("name").agg(
        F.min("row_key").alias("row_key"), F.min("doc_id").alias("least"), F.first("sig", True).alias("sig"), F.first("keys", True).alias("keys"))
    classes = settle(classes.withColumn("c", F.monotonically_increasing_id()), "minhash-classes")
    buckets = settle(classes.where("keys IS NOT NULL").select("c", "keys").mapInArrow(_unpacked(how), "c bigint, band int, key bigint"),
                     "minhash-buckets")
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = settle(buckets.join(sizes, "key"), "minhash-members")
    scores = members.groupBy("c").agg(F.sum("size").alias("score"))
    known = settle(classes.select("c", "row_key", "sig", "keys").join(scores, "c"), "minhash-known")
    members = members.select("band", "key", "c")
    sets = _whole_sets(docs, known, how, id_col, text_col)
    links = settle(_confirm(_pivot_cells(members, known, how), sets, how), "minhash-links")
    links = links.unionByName(_confirm(_open_cells(members, known, components(links), how), sets, how))
    linked = components(links).withColumnRenamed("vertex", "c")
    least = classes.select("c", "least")
    lowest = linked.join(least, "c").groupBy("component").agg(F.min("least").alias("lowest"))
    named = classes.select("c", "name", "least").join(linked.join(lowest, "component").select("c", "lowest"), "c", "left").select(
        "name", F.coalesce("lowest", "least").alias("component_id"))
    n = F.col("n").alias("n_shingles")
    return (rows.where("name IS NOT NULL").join(named, "name").select("doc_id", n, "component_id")
            .unionByName(rows.where("name IS NULL").select("doc_id", n, F.col("doc_id").alias("component_id"))))


def keep_one(docs: DataFrame, how: Sketch = Sketch(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the least id of each group. Rows without an id stay, as do repeated rows of an id that stays."""
    grouped = groups(docs, how, id_col, text_col).where("doc_id IS NOT NULL")
    gone = grouped.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("_stays"))
    gone = settle(gone.where("NOT _stays").select(F.col("doc_id").alias("_id")), "minhash-gone")
    kept = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id_col).cast("long").alias("_of"))
    return kept.join(gone, F.col("_of") == F.col("_id"), "left_anti").select("_doc.*")
