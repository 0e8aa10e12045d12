"""Byte-level BPE, word tokens and packing."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import DOCS, LONG, docs, table
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from walletscope.llm import bpe, packing, queries, word_tokens

RANKS, WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
CODER = bpe.Coder(RANKS, public_tokenizers.PATTERN)
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})
TOKENIZER = Tokenizer.from_file(WORDS)
TOKENIZER.encode_special_tokens = True
WORD_CODER = word_tokens.WordCoder(WORDS)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=80), max_size=5))
def test_encodes_as_tiktoken(texts):
    for text, ids in zip(texts, CODER.encode(texts)):
        assert ids.tolist() == ORACLE.encode_ordinary(text)
        assert CODER.decode(ids) == text.encode()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab th'e\u00e9\u00e8 \n.", max_size=60), max_size=5))
def test_overlapping_pairs_as_tiktoken(texts):
    assert [x.tolist() for x in CODER.encode(texts)] == [ORACLE.encode_ordinary(t) for t in texts]


def test_runs_long_texts_and_forgetting():
    for text in ("a" * 5000, "ab" * 3000, "\n" * 999, "!?" * 700, LONG):
        assert CODER.encode_long(text).tolist() == ORACLE.encode_ordinary(text)
    small = bpe.Coder(RANKS, public_tokenizers.PATTERN, kept_words=3)
    for text in ("one two three four five", "six seven eight nine ten", "one two"):
        assert small.encode([text])[0].tolist() == ORACLE.encode_ordinary(text)


def test_bpe_of_odd_rows(spark):
    got = bpe.encode(docs(spark), RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    texts = sorted((r.text or "" for r in docs(spark).collect()))
    assert sorted(r.decoded.decode() for r in got) == texts
    assert sorted(bytes(r.ids) for r in got) == sorted(as_bytes(ORACLE.encode_ordinary(t)) for t in texts)
    assert bpe.encode(docs(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark):
    got = {r.doc_id: r for r in queries.op3_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    for d in table(spark, "documents").collect():
        ids = ORACLE.encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(as_bytes(ids)).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=4),
       st.lists(st.text("abDs'tlÉß_-. \n01²ªİıΣ<|>", max_size=60), max_size=4))
def test_word_tokens_as_the_tokenizer(any_texts, near_texts):
    texts = any_texts + near_texts
    for text, ids in zip(texts, WORD_CODER.encode(texts)):
        assert ids.tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_long_word_tokens():
    assert WORD_CODER.encode_long(LONG).tolist() == TOKENIZER.encode(LONG, add_special_tokens=False).ids


def test_added_tokens_keep_their_ids(monkeypatch):
    as_it_is = Tokenizer.from_file(WORDS)
    texts = ["one<|endoftext|>two", "<|startoftext|> a b <|endoftext|>", "<|ENDOFTEXT|> x", "<|endoftext", "é漢<|endoftext|>",
             "a <|endoftext|><|endoftext|>", "plain words"]
    want = [as_it_is.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in WORD_CODER.encode(texts)] == want
    assert 49407 in want[0] and 49406 in want[1]
    monkeypatch.setattr(word_tokens, "STRETCH", 20)
    long = " ".join(texts * 5)
    assert WORD_CODER.encode_long(long).tolist() == as_it_is.encode(long, add_special_tokens=False).ids


# --- packing ---------------------------------------------------------------------------

@pytest.mark.parametrize("counts,weights", [
    ([5], [1.0]), ([5000, 3], [1.0, 1.0]), ([100_000, 40_000, 7, 0], [0.2, 0.5, 0.3, 0.1]),
    ([2048 * 512 * 3, 2048 * 512], [3.0, 1.0]), ([9, 8, 7], [0.0, 0.0, 1.0])])
def test_schedule_spends_every_queue_in_full_windows(counts, weights):
    counts = np.array(counts)
    phases = packing.schedule(counts, np.array(weights, float), 64)
    total = phases[-1].window + phases[-1].windows
    assert total == -(-counts.sum() // 64)
    edges = np.array([p.before(np.array([w]))[0] for p in phases for w in range(p.window, p.window + p.windows)]
                     + [phases[-1].before(np.array([total]))[0]])
    assert (edges[0] == 0).all() and (edges[-1] == counts).all() and (np.diff(edges, axis=0) >= 0).all()
    assert (np.diff(edges.sum(axis=1))[:-1] == 64).all()


def test_deficits_stay_below_a_token():
    quanta = packing._quanta(np.array([0.7, 0.2, 0.1]), 64)
    spent = packing.round_robin(quanta, 64)
    fair = np.arange(packing.CYCLE + 1)[:, None] * quanta / packing.CYCLE
    assert (np.abs(spent - fair) < 1).all() and (spent[-1] == quanta).all()


def check_pieces(pieces, rows, width):
    """Brute force over the pieces: each id once, sequences gapless and full but the last."""
    ids = sorted((as_bytes([*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 1]), i) for i, t in rows)
    found = {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        found.setdefault((p.sequence_id), []).append(p)
    for number, row in found.items():
        at = 0
        for p in sorted(row, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == width or number == max(found) and at <= width
    assert sorted(found) == list(range(len(found)))
    assert sum(p.length for p in pieces) == sum(len(b) // 4 for b, _ in ids)
    return found


def test_packing_of_odd_rows(spark):
    rows = docs(spark).filter("doc_id IS NULL OR doc_id <> 3")
    pieces = packing.pack(rows, WORDS, width=64).collect()
    check_pieces(pieces, [(r.doc_id, r.text) for r in rows.collect()], 64)
    for d in rows.collect():
        mine = sorted((p for p in pieces if p.doc_id == d.doc_id), key=lambda p: p.start)
        want = as_bytes([*TOKENIZER.encode(d.text or "", add_special_tokens=False).ids, 1])
        assert b"".join(bytes(p.ids) for p in mine) == want and {p.doc_tokens for p in mine} == {len(want) // 4}
    repeated = packing.pack(docs(spark), WORDS, width=64).collect()
    check_pieces(repeated, [(r.doc_id, r.text) for r in docs(spark).collect()], 64)
    assert packing.pack(docs(spark, []), WORDS).count() == 0


def test_windows_meet_the_targets_across_parts(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["the", "of", "quick", "fox"], k=rng.randint(1, 80))), "en", rng.choice("aaabc"), 0)
            for i in range(900)]
    table_ = spark.createDataFrame(rows, DOCS).repartition(7)
    found = check_pieces(packing.pack(table_, WORDS, width=128).collect(), [(r[0], r[1]) for r in rows], 128)
    tokens = {}
    for row in found.values():
        for p in row:
            tokens[p.source] = tokens.get(p.source, 0) + p.length
    share = {s: n / sum(tokens.values()) for s, n in tokens.items()}
    for number, row in found.items():
        if number < max(found) - 3:
            for s in "abc":
                assert abs(sum(p.length for p in row if p.source == s) - 128 * share[s]) < 2.5
    named = check_pieces(packing.pack(table_, WORDS, targets={"c": 0.5, "b": 0.25, "none": 0.1}, width=128).collect(),
                         [(r[0], r[1]) for r in rows], 128)
    first = [sum(p.length for p in named[0] if p.source == s) for s in "abc"]
    assert first[2] > first[1] > first[0]


def test_more_sources_than_queues(spark):
    rows = [(i, "the quick brown fox", "en", f"s{i % 9}", 0) for i in range(60)] + [(99, "x", "en", None, 0)]
    pieces = packing.pack(spark.createDataFrame(rows, DOCS), WORDS, width=32, max_queues=4).collect()
    check_pieces(pieces, [(r[0], r[1]) for r in rows], 32)


@pytest.mark.parametrize("counts", [[7], [5, 5], [1, 1, 1], [900, 70, 30, 9, 1, 1], [2 ** k for k in range(9, -1, -1)], [3] * 70])
def test_tokens_of_a_shared_queue_take_turns(counts):
    counts = np.array(counts)
    order = np.full(counts.sum(), -1)
    for i, n in enumerate(counts):
        at = packing.interleaved(counts, i, np.arange(n))
        assert (np.diff(at) > 0).all()
        order[at] = i
    assert (order >= 0).all()
    for i, n in enumerate(counts):
        fair = np.arange(1, len(order) + 1) * n / len(order)
        assert (np.abs(np.cumsum(order == i) - fair) < 3).all()
    vast = np.array([3 << 40, 5 << 40, 7 << 40])
    last = [int(packing.interleaved(vast, i, vast[i:i + 1] - 1)[0]) for i in range(3)]
    assert max(last) == vast.sum() - 1 and min(last) > vast.sum() - 20


def test_sources_of_a_long_tail_meet_their_shares(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices(["the", "of", "quick", "fox"], k=rng.randint(1, 60))), "en", f"s{i * 20 // 2000}", 0)
            for i in range(2000)]
    table_ = spark.createDataFrame(rows, DOCS).repartitionByRange(5, "doc_id")
    found = check_pieces(packing.pack(table_, WORDS, width=256, max_queues=4).collect(), [(r[0], r[1]) for r in rows], 256)
    tokens = {}
    for row in found.values():
        for p in row:
            tokens[p.source] = tokens.get(p.source, 0) + p.length
    assert len(tokens) == 20
    for number, row in found.items():
        if number < max(found) - 3:
            for s, n in tokens.items():
                assert abs(sum(p.length for p in row if p.source == s) - 256 * n / sum(tokens.values())) < 6


def test_every_named_target_has_its_share(spark):
    rows = [(i, "the quick brown fox", "en", f"s{i % 8}", 0) for i in range(800)]
    targets = {"s0": 0.3, "s1": 0.2, "s2": 0.1, "s3": 0.1, "s4": 0.1, "s5": 0.1, "s6": 0.05}
    pieces = packing.pack(spark.createDataFrame(rows, DOCS), WORDS, targets=targets, width=100, max_queues=4).collect()
    found = check_pieces(pieces, [(r[0], r[1]) for r in rows], 100)
    for s, share in targets.items():
        assert abs(sum(p.length for p in found[0] if p.source == s) - 100 * share) < 2


def test_packing_query(spark):
    import zlib

    got = queries.op1_packing(spark, "/root/testdata/sf0.001").collect()
    parts = {}
    for p in got:
        parts.setdefault(p.doc_id, []).append(p)
    for d in table(spark, "documents").collect():
        ids = as_bytes([*TOKENIZER.encode(d.text or "", add_special_tokens=False).ids, 1])
        at = 0
        for p in sorted(parts[d.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[4 * at:4 * (at + p.length)])
            at += p.length
        assert 4 * at == len(ids)


def test_memories_are_bounded_by_characters():
    """Very long words and chunks, as in scripts without blanks, push nothing beyond the bound."""
    rng = random.Random(6)
    long_words = ["".join(rng.choices("abcdefgh", k=4000)) for _ in range(60)]
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN, kept_chars=50_000)
    for w in long_words:
        coder.encode([w])
        assert coder.chars + coder.ids.used < 50_000 + 2 * 4000
    memory = word_tokens.Memory(1000, 10_000)
    for w in long_words:
        memory.keep([w], np.arange(10, dtype=np.uint32), np.array([10]))
    assert len(memory.number) == 2 and memory.ids.used == 20
    again = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    assert [x.tolist() for x in coder.encode(long_words)] == [x.tolist() for x in again.encode(long_words)]
