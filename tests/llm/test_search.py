"""Jaccard join, exact top-k, sharding."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, LONG, docs, table
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from walletscope.llm import components, jaccard, queries, shard, shingles, topk

# --- Jaccard join ----------------------------------------------------------------------


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    return [w for w in low.split(" ") if w]


def plain_sets(texts, n):
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    return sets


def plain_join(rows, n, percent):
    """Brute force by counting common shingles: (id, size, least id of the component)."""
    sets = plain_sets([t for _, t in rows], n)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in holders.get(x, ()))
        for j, k in common.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                parent[root(i)] = root(j)
        for x in s:
            holders.setdefault(x, []).append(i)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return sorted(((name, len(sets[i]), least.get(root(i)) if sets[i] else name) for i, (name, _) in enumerate(rows)), key=repr)


def joined(df, how):
    return sorted(map(tuple, jaccard.join(df, how).collect()), key=repr)


def test_join_of_odd_rows(spark):
    rows = [(r.doc_id, r.text) for r in docs(spark).collect()]
    for words, percent in ((4, 85), (5, 80), (1, 50)):
        assert joined(docs(spark), jaccard.Similarity(words, percent)) == plain_join(rows, words, percent)
    assert joined(docs(spark, []), jaccard.Similarity()) == []


def corpus(seed, families, copies, edits, vocabulary=400, shared=True):
    """Families of near copies, some of which also hold passages that many documents share."""
    rng = random.Random(seed)

    def text(k):
        return [f"w{rng.randrange(vocabulary)}" for _ in range(k)]

    passages = [text(30) for _ in range(3)]
    rows = []
    for _ in range(families):
        base = text(rng.choice([5, 12, 40, 150]))
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
            if shared and rng.random() < 0.4:
                own += rng.choice(passages)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("limit", [2, 6, 64])
@pytest.mark.parametrize("seed,families,copies,edits", [(1, 60, 6, 3), (2, 5, 60, 4), (3, 12, 25, 12)])
def test_join_against_brute_force_with_any_list_limit(spark, limit, seed, families, copies, edits):
    """Small limits make hard sets and families of nearly everything."""
    rows = corpus(seed, families, copies, edits)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for words, percent in ((4, 85), (3, 60)):
        assert joined(df, jaccard.Similarity(words, percent, list_limit=limit)) == plain_join(rows, words, percent)


@pytest.mark.parametrize("limit", [3, 8, 64])
def test_copies_met_in_many_stretches_count_once(spark, monkeypatch, limit):
    """Each row is a stretch of its own, so a batch of sets holds a class as often as it has copies."""
    monkeypatch.setattr(shingles, "STRETCH", 200)
    rng = random.Random(7)
    passage = [f"p{rng.randrange(400)}" for _ in range(30)]
    texts = []
    for _ in range(8):
        base = [f"w{rng.randrange(400)}" for _ in range(60)] + passage
        near = [" ".join([*base[:at], "other", *base[at + 1:]]) for at in (3, 25)]
        texts += [" ".join(base)] * (limit + 1) + near + [near[0]] * rng.randrange(limit)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for some in (df, df.orderBy(F.desc("doc_id")).coalesce(1)):
        assert joined(some, jaccard.Similarity(4, 80, list_limit=limit)) == plain_join(rows, 4, 80)


def test_join_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()]
    got = sorted(map(tuple, queries.op5_jaccard_join(spark, "/root/testdata/sf0.001").collect()), key=repr)
    assert got == plain_join(rows, 4, 85)


def test_keep_one_of_each_group(spark):
    rows = corpus(4, 20, 5, 2, shared=False)
    df = spark.createDataFrame([(i, t, i) for i, t in rows] + [(0, rows[0][1], 0)], "doc_id long, text string, _id long")
    kept = jaccard.keep_one(df, jaccard.Similarity(4, 85))
    assert kept.columns == df.columns
    assert sorted({r.doc_id for r in kept.collect()}) == sorted({c for _, _, c in plain_join(rows, 4, 85)})
    assert jaccard.keep_one(docs(spark, [])).count() == 0
    assert sorted((r.doc_id for r in jaccard.keep_one(docs(spark)).collect()), key=repr) == [1, 2, 3, 3, 5, 6, 7, None]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=10, unique=True).map(sorted), max_size=9), st.integers(1, 6))
def test_divide_skip(lists, t):
    counts = Counter(itertools.chain.from_iterable(lists))
    assert jaccard.divide_skip(lists, t) == sorted(m for m, k in counts.items() if k >= t)


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 50)],
                                   [(5, 4), (4, 3), (9, 8), (3, 9), (20, 21)]])
def test_components(spark, edges):
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = {r.vertex: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: root(v) for v in list(parent)}


# --- top-k ------------------------------------------------------------------------------

def plain_top(rows, k, scale=64):
    vectors = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sorted({i: a for i, a in sorted(vectors)}.items()):
        if q % 20 == 0:
            found = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in vectors if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, score int"


@pytest.mark.parametrize("blocks", [(2048, 8192), (3, 7)])
def test_top_k_of_odd_rows(spark, blocks):
    rng = random.Random(6)
    rows = [(i, [rng.choice([0.0, 0.5, -0.3, 0.01, 1.0]) for _ in range(rng.choice([4, 4, 6, 0]))], 1) for i in range(90)]
    rows += [(100, None, 1), (120, [1.0, None], 1), (140, [float("nan")], 1), (160, [float("inf")], 1), (None, [1.0], 1),
             (7, rows[7][1], 1), (20, rows[20][1], 1), (180, [1e5, -1e5, 1e5], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k=5, query_block=blocks[0], candidate_block=blocks[1], at_once=2)
    assert sorted(map(tuple, got.collect())) == plain_top([r[:2] for r in rows], 5)


def test_top_k_of_few_and_none(spark):
    for rows in ([], [(20, [1.0], 1)], [(1, [1.0], 1)], [(20, [1.0], 1), (3, [0.0], 1)]):
        got = topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0)
        assert sorted(map(tuple, got.collect())) == plain_top([r[:2] for r in rows], 20)


# --- sharding ---------------------------------------------------------------------------

def check_shards(rows, shards):
    by_shard = Counter(r.shard for r in rows)
    assert set(by_shard) <= set(range(shards))
    sizes = [by_shard.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in by_shard:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(by_shard[s]))


def test_shards_of_odd_rows(spark, tmp_path):
    clash = docs(spark).withColumn("shard", F.lit("mine")).withColumn("_bucket", F.lit("own"))
    out = shard.shard_documents(clash, 4)
    rows = out.collect()
    check_shards(rows, 4)
    assert Counter((r.doc_id, r.text, r._bucket) for r in rows) == Counter((r.doc_id, r.text, "own") for r in docs(spark).collect())
    assert all(r["size"] == 16 + len((r.text or "").encode()) for r in rows)
    assert shard.shard_documents(docs(spark, []), 4).count() == 0
    shard.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)


def test_shards_repeat_and_mix(spark):
    df = spark.createDataFrame([(i, f"text {i}" * (i % 7), "en", "a" if i % 3 else "b", 0) for i in range(1003)], DOCS)
    one = sorted(map(tuple, shard.shard_documents(df, 10, bucket_bytes=1000).select("doc_id", "shard", "slot").collect()))
    two = sorted(map(tuple, shard.shard_documents(df.repartition(5), 10, bucket_bytes=1000).select(
        "doc_id", "shard", "slot").collect()))
    assert one == two
    check_shards(shard.shard_documents(df, 10, bucket_bytes=1000).collect(), 10)
    other = sorted(map(tuple, shard.shard_documents(df, 10, seed=18).select("doc_id", "shard", "slot").collect()))
    assert other != one
    by_id = [s for _, s, _ in one]
    assert len(set(by_id[:60])) == 10 and abs(np.corrcoef(range(len(by_id)), by_id)[0, 1]) < 0.15


def test_shards_of_repeated_rows(spark):
    same = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"),
                                       F.lit("a").alias("source"))
    other = spark.range(500).select("id", F.concat(F.lit("text "), "id"), F.lit("b")).toDF("doc_id", "text", "source")
    size = 100_000  # bytes: the equal rows hold sixteen buckets
    out = shard.shard_documents(same.unionByName(other), 7, bucket_bytes=size)
    rows = out.collect()
    check_shards(rows, 7)
    assert Counter(r.doc_id for r in rows) == Counter({None: 100_000} | dict.fromkeys(range(500), 1))
    keyed = same.select(F.lit(16).cast("long").alias("size"), F.lit(1).alias("_key"), F.lit(2).alias("_id_key"), F.lit(3).alias("_bucket"))
    spread = shard._spread_repeated(keyed, 17, 20, size)
    held = [r["count"] for r in spread.groupBy("_bucket").count().collect()]
    assert len(held) == 20 and sum(held) == 100_000 and max(held) < 6000
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, spread.collect()))


def test_shard_query(spark):
    import zlib

    rows = queries.op10_shards(spark, "/root/testdata/sf0.01").collect()
    check_shards(rows, 40)
    texts = {d.doc_id: (d.text or "").encode() for d in table(spark, "documents", "sf0.01").collect()}
    assert len(rows) == len(texts) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id]) and r["size"] == 16 + len(texts[r.doc_id]) for r in rows)
