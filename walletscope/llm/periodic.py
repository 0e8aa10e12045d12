"""Runs of repeated words by online dyadic square catching, and texts without the repeats.

A *run* is a stretch of words with a smallest period q, at least two periods long, that no
neighbouring word extends. The words of a text are appended in stretches to ``Catchers``,
which never looks ahead:

- For every power of two L, each completed aligned block of L words is a catcher. It waits for
  a copy of itself 2L - 1 to 4L - 2 words later. Any square of such a period has a whole
  aligned block in its first half, so some catcher meets its copy before the square ends.
- An appended word ends one suffix of L words for each L. Exactly two live catchers can have
  their copy there, so it costs two comparisons of names for each L. Names are 64-bit
  hashes that double from level to level; what they claim is checked on the words.
- A met copy gives a period. Its stretch is followed to the left, and to the right as far as
  there are words; one that touches the end stays open and goes on with the next words.
  A stretch of two periods is a square, and the squares of a period merge into its run.
- Copies inside a run already known whose period divides theirs add nothing and are passed
  over, so a text that is one long repeat costs no more than any other.

State besides the words: per level L names and the blocks' names, about three names a word.

Defined results
- NULL, empty or blank text: no words, no runs, empty collapsed text. NULL id: a document.
- Very long text: appended stretch by stretch; its words and names are held by one task.
- Ties: runs come by start, then period. Repeated rows give repeated results.
- Empty table: empty result. ``find`` ignores extra columns; ``collapse`` passes them on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from walletscope.llm.shingles import mix
from walletscope.llm.worker import text_slices

#: Bytes of text handled at a time, and words appended at a time (more as the text grows).
STRETCH = 1 << 20
APPENDED = 1 << 14
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Catchers:
    """The squares of a growing sequence of word numbers; runs shorter than ``least`` words are not kept."""

    def __init__(self, least: int = 12):
        self.least = least
        self._room = np.zeros(1024, np.int64)
        self._n = 0
        self._tails: list[np.ndarray] = []   # by level: names of the last L suffixes
        self._blocks: list[np.ndarray] = []  # by level: names of the completed blocks
        self._open: dict[int, int] = {}      # period -> start of the stretch that touches the end
        self._ends: dict[tuple[int, int], int] = {}  # (period, start) -> end of a run

    def append(self, words: np.ndarray, last: bool = False) -> None:
        """Take more words; after those marked as ``last`` there are none."""
        begin, count = self._n, len(words)
        if begin + count > len(self._room):
            self._room = np.concatenate([self._room[:begin], np.zeros(begin + 2 * count, np.int64)])
        self._room[begin:begin + count] = words
        self._n = begin + count
        self._go_on(begin)
        names = mix(words.astype(np.uint64) * _ODD + _ODD)
        level, size = 0, 1
        while (3 * size - 1 if last else size) <= self._n:
            if level == len(self._tails):
                self._tails.append(np.zeros(size, np.uint64))
                self._blocks.append(np.zeros(0, np.uint64))
            if level:
                half = np.concatenate([before, lower])[:count]
                names = mix(half * _ODD + lower)
            self._blocks[level] = np.concatenate([self._blocks[level], names[(-begin - 1) % size::size]])
            self._catch(level, size, names, begin)
            before, lower = self._tails[level], names
            self._tails[level] = np.concatenate([before, names])[-size:]
            level, size = level + 1, 2 * size

    def _catch(self, level: int, size: int, names: np.ndarray, begin: int) -> None:
        """Copies of blocks that end within the appended words."""
        first = max(begin, 3 * size - 2)
        if first >= self._n:
            return
        ends = names[first - begin:]
        start = np.arange(first - size + 1, self._n - size + 1)
        near = (start - 2 * size + 1) // size
        blocks = self._blocks[level]
        one = np.flatnonzero(blocks[near] == ends)
        two = np.flatnonzero((blocks[near - 1] == ends) & (near > 0))
        block = np.concatenate([near[one], near[two] - 1]) * size
        if not len(block):
            return
        period = start[np.concatenate([one, two])] - block
        new = ~self._inside_runs(block, period, size)
        block, period = block[new], period[new]
        order = np.lexsort((block, period))
        block, period = block[order], period[order]
        cuts = np.flatnonzero(np.diff(period)) + 1
        for some, q in zip(np.split(block, cuts), period[np.concatenate([[0], cuts])].tolist() if len(period) else ()):
            if 8 * len(some) > 8 + self._n // 500:
                self._all_stretches(q)
            else:
                self._stretches(q, some.tolist())

    def _inside_runs(self, block: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
        """Whether block and copy lie in a known run whose period divides theirs.

        Runs of 3L - 1 words with periods up to L overlap in fewer than 2L words, so only the
        run that starts last before the block can hold both.
        """
        known = {(s, e): q for (q, s), e in sorted(self._ends.items(), reverse=True) if q <= size and e - s >= 3 * size - 1}
        if not known:
            return np.zeros(len(block), bool)
        starts, ends, periods = np.array(sorted((*at, q) for at, q in known.items())).T
        at = np.searchsorted(starts, block, "right") - 1
        return (at >= 0) & (ends[at] >= block + period + size) & (period % periods[at] == 0)

    def _stretches(self, q: int, blocks: list[int]) -> None:
        done = -1
        for at in blocks:
            if at < done or (q in self._open and at >= self._open[q]):
                continue
            words = self._room
            if words[at] != words[at + q]:
                continue  # two names agreed by chance
            end = self._right(at, q)
            done = end
            self._note(q, self._left(at, q), end)

    def _left(self, at: int, q: int) -> int:
        step = 32
        while at > 0:
            low = max(0, at - step)
            odd = np.flatnonzero(self._room[low:at] != self._room[low + q:at + q])
            if len(odd):
                return low + int(odd[-1]) + 1
            at, step = low, step * 4
        return 0

    def _right(self, at: int, q: int) -> int:
        step, top = 32, self._n - q
        while at < top:
            high = min(top, at + step)
            odd = np.flatnonzero(self._room[at:high] != self._room[at + q:high + q])
            if len(odd):
                return at + int(odd[0])
            at, step = high, step * 4
        return top

    def _all_stretches(self, q: int) -> None:
        top = self._n - q
        same = np.zeros(top + 2, np.int8)  # 1 where a word equals the one q later
        same[1:-1] = self._room[:top] == self._room[q:self._n]
        turns = np.flatnonzero(np.diff(same))
        starts, ends = turns[::2], turns[1::2]
        some = (ends - starts >= max(q, self.least - q)) | (ends == top)
        for s, e in zip(starts[some].tolist(), ends[some].tolist()):
            self._note(q, s, e)

    def _note(self, q: int, start: int, end: int) -> None:
        """A stretch in which each word equals the one q later, from ``start`` up to ``end``."""
        if end - start >= q and end + q - start >= self.least:
            self._ends[q, start] = end + q
        if end + q == self._n:
            self._open[q] = start

    def _go_on(self, was: int) -> None:
        """Follow the open stretches over the appended words."""
        for q, start in list(self._open.items()):
            del self._open[q]
            self._note(q, start, self._right(max(was - q, start), q))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of each run, by start and period; a stretch counts by its smallest period."""
        smallest: dict[tuple[int, int], int] = {}
        for (q, s), e in self._ends.items():
            smallest[s, e] = min(q, smallest.get((s, e), q))
        return sorted((s, e - s, q) for (s, e), q in smallest.items())


def runs_of(words: np.ndarray, least: int = 12, appended: int = APPENDED) -> list[tuple[int, int, int]]:
    """The runs of a whole sequence, appended stretch by stretch."""
    found, at = Catchers(least), 0
    while at < len(words):
        step = max(appended, at // 4)
        found.append(words[at:at + step], last=at + step >= len(words))
        at += step
    return found.runs()


def _finder(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def one(ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        found = split.flatten().dictionary_encode()
        names, at = found.dictionary, np.asarray(found.indices).astype(np.int64)
        real = np.asarray(pc.not_equal(names, ""))[at] if len(names) else np.zeros(0, bool)
        of = np.repeat(np.arange(len(texts)), np.asarray(split.value_lengths()))[real]
        at = at[real]
        counts = np.bincount(of, minlength=len(texts))
        kept, listed = np.ones(len(at), bool), []
        for end, n in zip(np.cumsum(counts).tolist(), counts.tolist()):
            runs = runs_of(at[end - n:end], least) if n >= least else []
            for start, length, q in runs:
                kept[end - n + start + q:end - n + start + length] = False
            listed.append([{"start": s, "length": k, "period": q} for s, k, q in runs])
        ends = np.concatenate([[0], np.cumsum(np.bincount(of[kept], minlength=len(texts)))])
        words = pa.ListArray.from_arrays(ends.astype(np.int32), names.take(pa.array(at[kept])))
        return pa.record_batch({
            "doc_id": ids, "n_words": counts.astype(np.int64),
            "runs": pa.array(listed, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
            "collapsed": pc.binary_join(words, " ")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch.column(1), STRETCH):
                yield one(batch.column(0)[part], texts)
    return run


def find(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_words, its ``runs`` of ``least`` words or more, and the ``collapsed`` text.

    Words end at ASCII white space. The collapsed text holds the words joined by single blanks,
    without those that some run holds after its first period.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shape = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words bigint, runs {RUN}, collapsed string"
    return rows.mapInArrow(_finder(least), shape)


def collapse(docs: DataFrame, least: int = 12, text_col: str = "text") -> DataFrame:
    """``docs`` with collapsed texts; a text without runs stays as it is, with its white space."""
    rest = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(F.struct(*rest).alias("rest") if rest else F.lit(0).alias("rest"),
                                F.col(text_col).alias("text")).alias("_row"), F.col(text_col).alias("_text"))
    found = find(rows, least, "_row", "_text")
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("doc_id.text"))
    return found.select(*(text.alias(c) if c == text_col else F.col("doc_id.rest").getField(c).alias(c) for c in docs.columns))
