"""Byte-level BPE encoding by corpus-level merge replay, and decoding.

The corpus of a replay is the set of distinct words (matches of the pre-tokenizer
pattern) of a stretch of documents that the worker has not met before. An inverted
index lists, for each token pair that can merge, its positions in all those words; the
pair's key is the rank it merges to. Ranks are replayed in rising order, all positions
of a rank at once; a merge touches only the two neighbours of its position, whose new
pairs enter the index. Where a merge could make a pair of a lower rank, the rest of that
word waits, so each word sees its merges in just the order that encoding it alone would.

Texts go through in stretches of bounded size and known words are kept up to a fixed
number, so memory does not grow with the partition, nor with one very long text.

Defined results
- NULL text: empty, no ids. NULL id: passes through. Repeated rows: encoded alike.
- Empty table: empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from walletscope.llm.worker import kept, text_slices

SCHEMA = "doc_id long, ids binary, decoded binary"
#: Characters of text handled at a time; distinct words kept by one worker, and their characters and ids.
STRETCH, KEPT_WORDS, KEPT_CHARS = 1 << 21, 400_000, 1 << 23


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Replay:
    """Merges all words of a corpus by their ranks."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {r: b for b, r in ranks.items()}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {ranks[t[:i]] << 32 | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks}
        order = np.argsort(keys := np.fromiter(pairs, np.int64, len(pairs)))
        self.pairs = np.append(keys[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], -1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks that adjacent tokens merge to, -1 where they don't."""
        pair = left << 32 | right
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.merged[at], -1)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the words one after the other, and how many each word has."""
        whole = [self.ranks.get(w, -1) for w in words]
        corpus = [w for w, known in zip(words, whole) if known < 0]
        ids, word = self._replay(corpus)
        known = np.array(whole, np.int64).reshape(-1)
        counts = np.ones(len(words), np.int64)
        counts[known < 0] = np.bincount(word, minlength=len(corpus)) if corpus else 0
        ends = np.cumsum(counts)
        result = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        single = np.zeros(len(result), bool)
        single[(ends - counts)[known >= 0]] = True
        result[single], result[~single] = known[known >= 0], ids
        return result, counts

    def _replay(self, corpus: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter(map(len, corpus), np.int64, len(corpus))
        n = int(lengths.sum())
        # by position: its token (-1 once merged away), word, neighbours (n for none) and the rank of its pair
        token = np.append(self.byte[np.frombuffer(b"".join(corpus), np.uint8)], -1)
        word = np.append(np.repeat(np.arange(len(corpus)), lengths), -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[np.cumsum(lengths)[lengths > 0] - 1] = n
        before[(np.cumsum(lengths) - lengths)[lengths > 0]] = n
        pair = np.full(n + 1, -1)
        inner = np.flatnonzero(after[:n] < n)
        pair[inner] = self.rank(token[inner], token[inner + 1])

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(positions: np.ndarray, ranks: np.ndarray) -> None:
            """Add positions to the index, under the ranks of their pairs."""
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
            first = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(ranks) else ranks
            for r, a, b in zip(ranks[first].tolist(), first.tolist(), [*first[1:].tolist(), len(ranks)]):
                if r in index:
                    index[r].append(positions[a:b])
                else:
                    index[r] = [positions[a:b]]
                    heapq.heappush(heap, r)

        some = np.flatnonzero(pair >= 0)
        enter(some, pair[some])
        while heap:
            r = heapq.heappop(heap)
            listed = index.pop(r)
            p = np.unique(np.concatenate(listed)) if len(listed) > 1 else listed[0]
            p = p[pair[p] == r]
            if not len(p):
                continue
            if len(p) > 1 and (word[p[1:]] == word[p[:-1]]).any():
                p, wait = self._in_turn(p, r, token, word, after, before)
                enter(wait, np.full(len(wait), r))
            q = after[p]
            beyond = after[q]
            token[p], token[q], pair[q] = r, -1, -1
            after[p], before[beyond] = beyond, p
            pair[p] = -1
            left = before[p]
            touched = np.concatenate([p[beyond < n], left[left < n]])
            if len(touched):
                new = self.rank(token[touched], token[after[touched]])
                pair[touched] = new
                enter(touched[new >= 0], new[new >= 0])
        alive = token[:n] >= 0
        return token[:n][alive], word[:n][alive]

    def _in_turn(self, p: np.ndarray, r: int, token: np.ndarray, word: np.ndarray, after: np.ndarray,
                 before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The positions of rank r that may merge now, and those that must wait.

        Of a chain of overlapping pairs every second one merges. A word whose merge could
        make a pair that comes first, or again r, merges its leftmost pair only.
        """
        follows = np.append(False, p[1:] == after[p[:-1]])
        chain = np.maximum.accumulate(np.where(follows, 0, np.arange(len(p))))
        p = p[(np.arange(len(p)) - chain) % 2 == 0]
        made = np.full(len(p), r)
        right, left = token[after[after[p]]], token[before[p]]
        soon = [self.rank(made, right), self.rank(left, made), self.rank(made, made)]
        early = np.logical_or.reduce([(s >= 0) & (s <= r) for s in soon])
        if not early.any():
            return p, p[:0]
        first = np.append(True, word[p[1:]] != word[p[:-1]])
        held = np.isin(word[p], word[p[early]]) & ~first
        return p[~held], p[held]


class Gather:
    """Variable-length rows of one flat array, gathered by row number."""

    def __init__(self, kind: type) -> None:
        self.flat, self.used = np.zeros(1 << 16, kind), 0
        self.start, self.length = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.rows = 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        """Add rows, given one after the other."""
        rows, total = len(lengths), len(values)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + rows > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.flat[self.used:self.used + total] = values
        self.start[self.rows:self.rows + rows] = self.used + np.cumsum(lengths) - lengths
        self.length[self.rows:self.rows + rows] = lengths
        self.used, self.rows = self.used + total, self.rows + rows

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows one after the other, and their lengths."""
        lengths = self.length[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.start[at] - ends + lengths, lengths)], lengths


class Numbered(dict):
    """Numbers words as they are asked for; ``new`` lists those met for the first time."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class Coder:
    """Encodes and decodes texts with a bounded memory of words."""

    def __init__(self, ranks_path: str, pattern: str, kept_words: int = KEPT_WORDS, kept_chars: int = KEPT_CHARS) -> None:
        ranks = read_ranks(ranks_path)
        self.replay, self.pattern, self.kept_words, self.kept_chars = Replay(ranks), regex.compile(pattern), kept_words, kept_chars
        self.bytes = Gather(np.uint8)
        tokens = [self.replay.token.get(r, b"") for r in range(max(ranks.values()) + 1)]
        self.bytes.extend(np.frombuffer(b"".join(tokens), np.uint8), np.array([*map(len, tokens)]))
        self._forget()

    def _forget(self) -> None:
        self.known = Numbered()
        self.ids = Gather(np.uint32)
        self.chars = 0

    def _words(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words in ``ids``, replaying those not met before."""
        if len(self.known) > self.kept_words or self.chars + self.ids.used > self.kept_chars:
            self._forget()
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        if new := self.known.new:
            self.ids.extend(*self.replay.encode([w.encode() for w in new]))
            self.chars += sum(map(len, new))
            self.known.new = []
        return at

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text; the texts' new words are one corpus."""
        words = [self.pattern.findall(t) for t in texts]
        ids, lengths = self.ids_of([w for ws in words for w in ws])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        cuts = np.cumsum([0, *map(len, words)])
        return [ids[ends[a]:ends[b]] for a, b in zip(cuts, cuts[1:])]

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = self._words(words)  # may replace ``ids``
        return self.ids.take(at)

    def encode_long(self, text: str) -> np.ndarray:
        """As ``encode``, in stretches cut where no word can cross: before a blank between two non-blanks."""
        parts, at = [], 0
        while at < len(text):
            cut = safe_cut(text, at + STRETCH)
            parts += self.encode([text[at:cut]])
            at = cut
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.bytes.take(ids.astype(np.int64))[0].tobytes()


_CUT = regex.compile(r"(?<=[\p{L}\p{N}]) (?=[\p{L}\p{N}])")


def safe_cut(text: str, at: int) -> int:
    """The first place from ``at`` where a blank stands between letters or digits, else the end."""
    found = _CUT.search(text, at) if at < len(text) else None
    return found.start() if found else len(text)


def _encoding(ranks_path: str, pattern: str, decoded: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = kept(("bpe", ranks_path, pattern), lambda: Coder(ranks_path, pattern))
        for batch in batches:
            for part, some in text_slices(batch.column(1), STRETCH):
                found = coder.encode(some) if len(some) > 1 or len(some[0]) <= STRETCH else [coder.encode_long(some[0])]
                yield pa.record_batch({
                    "doc_id": batch.column(0)[part],
                    "ids": pa.array([x.astype("<u4").tobytes() for x in found], pa.binary()),
                    "decoded": pa.array([coder.decode(x) if decoded else None for x in found], pa.binary())})
    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, decoded: bool = False, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, ids (little-endian uint32) and, if asked for, the bytes the ids decode to."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_encoding(ranks_path, pattern, decoded), SCHEMA)
