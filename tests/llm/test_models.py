"""Personal data, toxicity and the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from helpers import DOCS, LONG, docs, table
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from walletscope.llm import pii, queries, tagger, toxicity
from walletscope.llm.labelled_spans import examples

SF = "/root/testdata/sf0.001"

# --- personal data -----------------------------------------------------------------------

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    """Brute force: the four patterns as they stand, then the checks."""
    def luhn(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            n = int(c) * (1 + i % 2)
            total += n - 9 if n > 9 else n
        return total % 10 == 0

    def fits(kind, found):
        d = re.sub("[^0-9]", "", found)
        return (kind == 0 or kind == 1 and all(int(p) <= 255 for p in found.split("."))
                or kind == 2 and 16 <= len(d) <= 19 and luhn(d) or kind == 3 and 8 <= len(d) <= 15)

    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if fits(k, m[0])]


@settings(max_examples=400, deadline=None)
@given(st.text("ab1.25@ -+()%_9\n", max_size=70))
def test_base_spans(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_spans_of_long_runs():
    for text in ("a" * 200_000, "1" * 100_000, "1.2.3." * 20_000, "@" * 50_000, "a@b." * 20_000, "+1(" * 30_000):
        pii.base_spans(text)


def test_gradients_of_the_tagger():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in tagger.init(7, 3, 3, rng).items()}
    x, y = rng.integers(0, 7, (6, 4)), rng.integers(0, 3, (6, 4))

    def loss(q):
        unary = sum(tagger.run_lstm(q, d, x)[0].astype(np.float64) @ q[f"o{d}"] for d in "fb")
        return tagger.crf_loss(q, unary, y)[0]

    sides = {d: tagger.run_lstm(p, d, x, keep=True) for d in "fb"}
    unary = sum(sides[d][0] @ p[f"o{d}"] for d in "fb")
    _, d_unary, d_step, d_first = tagger.crf_loss(p, unary, y)
    grads = {"step": d_step, "first": d_first}
    for d in "fb":
        out, kept = sides[d]
        grads[f"o{d}"] = np.einsum("tbh,tbk->hk", out, d_unary)
        tagger.back_lstm(p, d, x, kept, d_unary @ p[f"o{d}"].T, grads)
    for name, g in grads.items():
        at = tuple(rng.integers(0, s) for s in p[name].shape)
        moved = []
        for step in (1e-3, -1e-3):
            q = dict(p)
            q[name] = p[name].copy()
            q[name][at] += step
            moved.append(loss(q))
        assert abs((moved[0] - moved[1]) / 2e-3 - g[at]) < 2e-3, name


def test_viterbi_against_all_paths():
    import itertools

    rng = np.random.default_rng(1)
    p = tagger.init(5, 3, 3, rng)
    x = rng.integers(0, 5, (5, 6))
    tags, unary = tagger.decode(p, x)
    for b in range(6):
        def score(path):
            return (p["first"][path[0]] + sum(unary[t, b, k] for t, k in enumerate(path))
                    + sum(p["step"][i, j] for i, j in zip(path, path[1:])))
        assert abs(score(tags[:, b]) - max(map(score, itertools.product(range(3), repeat=5)))) < 1e-4


def test_tagger_on_held_out_spans():
    found = right = wanted = 0
    for text, spans in examples(400, 96, 12345):
        chars = np.zeros((96, 1), np.int64)
        chars[:len(text), 0] = pii.symbols(text)
        tags, unary = tagger.decode(pii.trained(), chars)
        got = {s[:3] for s in pii._tagged(tags[:len(text), 0], unary[:len(text), 0])}
        found, right, wanted = found + len(got), right + len(got & set(spans)), wanted + len(spans)
    assert right / found > 0.93 and right / wanted > 0.93


def test_added_spans():
    text = "call (988) 555-2485 now, or jo.lee(at)mail.com, +1 (269) 555-3296 4111111111111111 paid 12.50 on 2024-05-06"
    base = pii.base_spans(text)
    added = pii.added_spans([text], [base], pii.trained())[0]
    shown = {(pii.KINDS[k], text[a:b]) for k, a, b in added}
    assert ("phone", "(988) 555-2485") in shown and ("card", "4111111111111111") in shown
    assert not any("12.50" in s or "2024" in s for _, s in shown)
    far = "word " * 100_000 + text + " word" * 100
    moved = pii.added_spans([far], [pii.base_spans(far)], pii.trained())[0]
    assert {(pii.KINDS[k], far[a:b]) for k, a, b in moved} == shown


def test_added_spans_are_those_of_all_windows():
    rng = random.Random(5)
    words = ["mail", "me", "contact", "please", "or", "write"]
    texts = []
    for _ in range(150):
        host = ".".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 14))) for _ in range(rng.randint(2, 14)))
        texts.append(" ".join(rng.choices(words, k=rng.randint(0, 25)) + ["jane", "(at)", host] + rng.choices(words, k=12)))
    bases = [pii.base_spans(t) for t in texts]
    got = pii.added_spans(texts, bases, pii.trained())
    want = []
    for text, base in zip(texts, bases):
        found = []
        for at in range(0, len(text), 64):
            chars = pii.symbols(text[at:at + 128])[:, None]
            tags, unary = tagger.decode(pii.trained(), chars)
            found += [(k, at + a, at + b, s) for k, a, b, s in pii._tagged(tags[:, 0], unary[:, 0])]
        want.append(pii.reconcile(text, found, base))
    assert got == want
    assert sum(b - a > 90 for spans in want for _, a, b in spans)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.just(3), st.integers(0, 22), st.integers(8, 15), st.integers(1, 9)), max_size=6))
def test_reconciling_spans_of_a_kind(found):
    """Phone spans that overlap become one, which stays if its digits are few enough."""
    import itertools

    text = " 1 " * 30  # spans of whole units stand apart
    spans = {(3, 3 * a, 3 * (a + n)): float(s) for _, a, n, s in found if a + n <= 30 and n >= 8}
    joined = pii.reconcile(text, [(k, a, b, s) for (k, a, b), s in spans.items()], [])
    assert all(b <= c for (_, _, b), (_, c, _) in itertools.pairwise(joined))
    if spans:  # overlapping spans of a kind are one span; too many digits make none
        merged = []
        for _, a, b in sorted(spans):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        assert joined == [(3, a, b) for a, b in merged if (b - a) // 3 <= 15]


def test_reconciling_across_kinds_takes_the_highest_total():
    text = " 4111 1111 1111 1111 22 "
    card, phone = (2, 1, 20, 5.0), (3, 16, 23, 9.0)
    assert pii.reconcile(text, [card, (3, 11, 23, 4.0)], []) == [(2, 1, 20)]
    assert pii.reconcile(text, [card, (3, 11, 23, 6.0)], []) == [(3, 11, 23)]
    assert pii.reconcile(text, [card, phone], [(0, 0, 2)]) == []  # too few digits; touches a base span


def test_find_and_redact_odd_rows(spark):
    got = {r.doc_id: r for r in pii.find(docs(spark)).collect()}
    assert [s.kind for s in got[None].base] == ["email"] and got[None].added == []
    assert all(not r.base and not r.added for i, r in got.items() if i is not None)
    clean = {r.doc_id: r.text for r in pii.redact(docs(spark)).collect()}
    assert clean[None] == "An id is missing here, mail <EMAIL> now." and clean[1] is None and clean[5] == LONG
    assert pii.find(docs(spark, [])).count() == pii.redact(docs(spark, [])).count() == 0


def test_personal_data_query(spark):
    got = {r.doc_id: r for r in queries.op2_personal_data(spark, "/root/testdata/sf0.01").collect()}
    for d in table(spark, "documents", "sf0.01").collect():
        spans, row = plain_spans(d.text or ""), got[d.doc_id]
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in spans) for i in range(4)]
        every = row.spans.split(",") if row.spans else []
        assert set(listed) <= set(every)
        assert every == sorted(every, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))


# --- toxicity ---------------------------------------------------------------------------

def abuse(n, seed=2):
    rng = random.Random(seed)
    clean = [f"{a}{b}" for a in ("sun", "tree", "lake", "road", "hill") for b in ("", "light", "side", "way", "top")]
    rows = []
    for i in range(n):
        words = rng.choices(clean, k=rng.randint(3, 60))
        bad, odd = i % 5 == 0, i % 7 == 0
        if bad:
            words.insert(rng.randrange(len(words)), "vilsk" + rng.choice(["a", "en", "ig", "or"]))
        if odd:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), "en", "s", 0, int(bad), int(odd)))
    return rows


def test_chain_on_held_out_documents(spark):
    rows = abuse(600)
    known = spark.createDataFrame([r[:5] for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[5], r[6]) for r in rows if r[0] < 400], "doc_id long, bad int, odd int")
    model = toxicity.train(known, labels, {"odd": F.col("odd"), "bad": F.col("bad")})
    judged = {r.doc_id: r for r in toxicity.judge(known, model).collect()}
    for i, _, _, _, _, bad, odd in rows:
        assert judged[i].bad == bool(bad) and judged[i].odd == bool(odd), i
    clean = toxicity.keep_clean(known.withColumn("p_bad", F.lit("mine")), model, "bad")
    assert clean.columns == [*known.columns, "p_bad"]
    assert sorted(r.doc_id for r in clean.collect()) == [r[0] for r in rows if not r[5]]


def test_later_models_learn_from_out_of_fold_odds():
    rng = np.random.default_rng(4)
    how = toxicity.Chain(width=64, folds=4, support=1, evidence=0.1)
    n = 400
    y = np.column_stack([rng.random(n) < 0.4] * 2).astype(float)
    feature = np.where(y[:, 0] > 0, rng.integers(0, 4, n), rng.integers(2, 8, n))
    x = toxicity.Examples(np.arange(n), feature, np.ones(n), n)
    chain = toxicity.fit_chain(x, y, rng.integers(0, 4, n), how)
    assert chain[0].earlier.size == 0 and chain[1].earlier.size == 1 and chain[1].earlier[0] > 0


def test_chain_of_odd_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, y int")
    for labels in (empty, spark.createDataFrame([(3, 1), (5, 1), (None, 0)], "doc_id long, y int")):
        model = toxicity.train(docs(spark), labels, {"y": F.col("y")})
        judged = toxicity.judge(docs(spark), model).collect()
        assert len(judged) == 9 and not any(r.y for r in judged)
        assert toxicity.keep_clean(docs(spark), model, "y").count() == 9
    mixed = spark.createDataFrame([(i, None if i == 2 else i % 2) for i in (1, 2, 3, 3, 4, 5)], "doc_id long, y int")
    model = toxicity.train(docs(spark), mixed, {"y": F.col("y")}, toxicity.Chain(support=1))
    assert toxicity.judge(docs(spark), model).count() == 9
    assert toxicity.judge(docs(spark, []), model).count() == 0


def test_toxicity_query_against_the_labels(spark):
    judged = queries.op8_toxicity(spark, "/root/testdata/sf0.01")
    assert judged.count() == table(spark, "documents", "sf0.01").count()
    told = judged.select("doc_id", F.col("toxic").alias("found")).join(table(spark, "labels", "sf0.01"), "doc_id").collect()
    toxic = [r for r in told if r.toxic == 1]
    assert sum(r.found for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.found for r in told if r.toxic == 0) <= 0.01 * len(told)


# --- pipeline ---------------------------------------------------------------------------

def test_pipeline_stages_keep_columns_and_handle_nothing(spark):
    for rows in (None, []):
        left = docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, left, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert got.columns == left.columns
                left = got
        assert got.count() >= (rows is None)


def test_pipeline_against_its_stages_by_brute_force(spark):
    """The ids and ids' tokens that come out, from plain versions of the middle stages."""
    import public_tokenizers
    from test_search import plain_join
    from tokenizers import Tokenizer

    documents = table(spark, "documents")
    model = queries.toxicity_model(documents, table(spark, "labels"))
    clean = [(r.doc_id, r.text) for r in toxicity.judge(documents, model).collect() if not r.toxic]
    newest = {}
    for i, t in sorted(clean):
        newest[re.sub("[A-Z]", lambda m: m[0].lower(), t or "")] = (i, t)
    alone = sorted(newest.values())
    first = {c for _, _, c in plain_join(alone, 5, 80)}
    texts = {}
    for i, t in alone:
        if i in first:
            base = pii.base_spans(t or "")
            texts[i] = pii.masked(t or "", base + pii.added_spans([t or ""], [base], pii.trained())[0])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {}
    for p in corpus_pipeline.run(spark, SF).collect():
        found.setdefault(p.doc_id, {})[p.start] = bytes(p.ids)
    assert {i: b"".join(x for _, x in sorted(parts.items())) for i, parts in found.items()} == {
        i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for i, t in texts.items()}


def test_twins(spark):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    for name, sql in queries.TWINS.items():
        df = queries.QUERIES[name](spark, SF)
        want = con.execute(sql)
        order = [[c[0] for c in want.description].index(c) for c in sorted(df.columns)]
        expected = sorted(repr(tuple(row[i] for i in order)) for row in want.fetchall())
        assert sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect()) == expected, name
