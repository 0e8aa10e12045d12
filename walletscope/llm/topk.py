"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

A vector is a sparse row of integer weights by dimension. Rows are dealt into blocks
of bounded size; each pair of a query block and a candidate block is one task. There
an inverted file lists, for each dimension, the candidates and their weights; every
query scatters weight times posting into a dense score array, term by term, keeps its
k best by partition selection, and the bests of all candidate blocks are merged.

Defined results
- Vectors that are NULL or hold NULL or non-finite components take no part, nor do rows with a NULL id.
- Missing dimensions count as zero, so lengths may differ.
- Rows that share a query's id are its own and no candidates of it. Repeated candidate rows
  each take a rank; a repeated query id is searched once, with its largest vector in array order.
- Equal scores go to the smaller id. Fewer than k candidates: all. Empty table: empty result.
- Extra columns are ignored. Weights must keep scores within a long.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

SCHEMA = "query_id long, vec_id long, score long"


def weights(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component, NULL for a vector that takes no part."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _rows(vectors: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids by rising order, and the non-zero weights as (row, dimension, weight)."""
    vectors = vectors.sort_by("vec_id")
    lists = vectors["weights"].combine_chunks()
    lengths = np.asarray(lists.value_lengths())
    values = np.asarray(lists.flatten())
    row = np.repeat(np.arange(len(lengths)), lengths)
    dim = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = values != 0
    return np.asarray(vectors["vec_id"]), row[some], dim[some], values[some]


def _by_dim(row: np.ndarray, dim: np.ndarray, weight: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    order = np.argsort(dim, kind="stable")
    row, dim, weight = row[order], dim[order], weight[order]
    dims, starts = np.unique(dim, return_index=True)
    ends = [*starts[1:], len(dim)]
    return {int(d): (row[a:b], weight[a:b]) for d, a, b in zip(dims, starts, ends)}


def _best(k: int, at_once: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(queries) or not len(candidates):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.int64())})
        q_ids, *q = _rows(queries)
        c_ids, *c = _rows(candidates)
        n = len(c_ids)
        largest = [int(np.abs(w).max(initial=0)) for w in (q[2], c[2])]
        terms = 1 + max(int(q[1].max(initial=0)), int(c[1].max(initial=0)))
        kind = np.int32 if largest[0] * largest[1] * terms < 2**31 else np.int64
        postings = {}
        for d, (at, w) in _by_dim(*c).items():
            if 2 * len(at) > n:  # a posting of most candidates is kept as a filled array
                full = np.zeros(n, kind)
                full[at] = w
                postings[d] = (slice(None), full)
            else:
                postings[d] = (at, w.astype(kind))
        found = []
        for first in range(0, len(q_ids), at_once):
            part = (q[0] >= first) & (q[0] < first + at_once)
            ids = q_ids[first:first + at_once]
            scores = np.zeros((len(ids), n), kind)
            for d, (at, w) in _by_dim(q[0][part] - first, q[1][part], q[2][part]).items():
                if d in postings:
                    where, values = postings[d]
                    gain = w.astype(kind)[:, None] * values[None, :]
                    if isinstance(where, slice):
                        scores[at] += gain
                    else:
                        scores[at[:, None], where[None, :]] += gain
            found += [_select(i, row, c_ids, k) for i, row in zip(ids, scores)]
        return pa.table({name: pa.array(np.concatenate([f[j] for f in found]), pa.int64())
                         for j, name in enumerate(("query_id", "vec_id", "score"))})
    return search


def _select(query_id: int, scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of one score array; ids rise, so among equal scores the first positions win."""
    own = slice(*np.searchsorted(ids, [query_id, query_id + 1]))
    keep = np.ones(len(ids), bool)
    keep[own] = False
    at = np.flatnonzero(keep)
    if len(at) > k:
        left = scores[at]
        bar = np.partition(left, len(left) - k)[len(left) - k]
        above = at[left > bar]
        at = np.concatenate([above, at[left == bar][:k - len(above)]])
    return np.full(len(at), query_id), ids[at], scores[at].astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, query_block: int = 2048,
          candidate_block: int = 8192, at_once: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best candidates of every query."""
    rows = vectors.select("vec_id", weights(F.col("embedding"), scale).alias("weights"), is_query.alias("_q")
                          ).filter("vec_id IS NOT NULL AND weights IS NOT NULL")
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("_q")).first()
    c_blocks, q_blocks = max(1, -(-total // candidate_block)), max(1, -(-asked // query_block))

    def block(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n))

    def all_blocks(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    asked_rows = rows.filter("_q").groupBy("vec_id").agg(F.max("weights").alias("weights"))
    q = asked_rows.withColumn("qb", block(q_blocks, 1)).withColumn("cb", all_blocks(c_blocks))
    c = rows.drop("_q").withColumn("cb", block(c_blocks, 2)).withColumn("qb", all_blocks(q_blocks))
    near = q.groupBy("qb", "cb").cogroup(c.groupBy("qb", "cb")).applyInArrow(_best(k, at_once), SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
