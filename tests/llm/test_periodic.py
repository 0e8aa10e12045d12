"""Periodic runs, by brute force over every period."""

import hashlib
import random
import re
import zlib

import numpy as np
from helpers import docs, table
from hypothesis import given, settings, strategies as st

from walletscope.llm import periodic, queries


def plain_runs(words, least=12):
    """Every maximal stretch of every period, smallest period first."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_collapsed(words, runs):
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=80), st.integers(1, 90), st.sampled_from([2, 12]))
def test_runs_of_small_alphabets(words, appended, least):
    assert periodic.runs_of(np.array(words, np.int64), least, appended) == plain_runs(words, least)


def test_runs_of_planted_cycles():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randint(1, 150)
        words = [rng.randrange(rng.choice([3, 40])) for _ in range(n)]
        for _ in range(rng.randrange(1, 4)):
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            words[rng.randrange(n)] = 99
        for appended in (1, 16, 1000):
            assert periodic.runs_of(np.array(words), 12, appended) == plain_runs(words)


def test_squares_are_known_as_soon_as_they_end():
    """Online: after each word the runs are those of the words so far."""
    rng = random.Random(5)
    words = [rng.randrange(2) for _ in range(60)]
    catchers = periodic.Catchers(2)
    for i, w in enumerate(words):
        catchers.append(np.array([w]))
        assert catchers.runs() == plain_runs(words[:i + 1], 2)


def test_one_repeat_of_a_million_words_is_one_run():
    for q in (1, 2, 3, 7, 1000):
        assert periodic.runs_of(np.arange(10**6) % q) == [(0, 10**6, q)]
    twice = np.tile(np.random.default_rng(1).integers(0, 10**6, 200_000), 2)
    assert (0, 400_000, 200_000) in periodic.runs_of(twice)


def test_find_in_odd_rows(spark):
    rows = docs(spark).withColumnRenamed("lang", "runs")
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find(rows).collect()), key=repr)
    expected = []
    for r in rows.collect():
        words = plain_words(r.text)
        runs = [(0, 120_000, 4)] if r.doc_id == 5 else plain_runs(words)
        expected.append((r.doc_id, len(words), runs, plain_collapsed(words, runs)))
    assert got == sorted(expected, key=repr)
    assert periodic.find(docs(spark, [])).count() == 0


def test_collapse_keeps_columns(spark):
    rows = docs(spark).withColumnRenamed("lang", "runs").withColumnRenamed("source", "collapsed")
    got = periodic.collapse(rows)
    assert got.columns == rows.columns and got.dtypes == rows.dtypes
    texts = {r.n_chars: r.text for r in got.collect()}
    assert texts[4] == " \n\t " and "the quick brown fox" in texts.values()
    assert got.where("doc_id IS NULL").first().runs == "en"
    assert periodic.collapse(docs(spark, [])).count() == 0


def test_query(spark):
    expected = []
    for r in table(spark, "documents").select("doc_id", "text").collect():
        words, h = plain_words(r.text), zlib.crc32(str(r.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs_fast(words)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2])) if runs else None
        expected.append((r.doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else [None] * 4),
                         hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest(),
                         hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest()))
    got = queries.op13_repeats(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert sum(r.n_runs > 0 for r in got) > 10


def plain_runs_fast(words, least=12):
    """The same brute force with each period's comparison in one step."""
    numbers = {}
    w = np.array([numbers.setdefault(x, len(numbers)) for x in words])
    found = {}
    for q in range(1, len(w) // 2 + 1):
        turns = np.flatnonzero(np.diff(np.concatenate([[0], w[:-q] == w[q:], [0]]).astype(int)))
        for i, j in zip(turns[::2].tolist(), turns[1::2].tolist()):
            if j - i >= q and j + q - i >= least:
                found.setdefault((i, j + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())
