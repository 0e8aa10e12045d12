"""Documents as sets of hashed word shingles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from walletscope.llm.worker import text_slices

#: Bytes of text handled at a time.
STRETCH = 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # odd multipliers


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * _B
    h = (h ^ (h >> np.uint64(29))) * _A
    return h ^ (h >> np.uint64(32))


def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n word hashes."""
    rows = len(hashes) - n + 1
    h = np.full(rows, n, np.uint64)
    for i in range(n):
        h = mix(h * _A + hashes[i:i + rows])
    return h


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The distinct shingles of each text as rising 64-bit hashes.

    A-Z are lower-cased and words end at ASCII white space. With fewer words than a
    shingle has, the whole sequence is one; without words the set is empty. Each
    distinct word of the texts is hashed once.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array([t or "" for t in texts], pa.large_string())))
    found = split.flatten().dictionary_encode()
    names = found.dictionary.to_pylist()
    of_name = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    real = np.array([bool(w) for w in names], bool)  # blanks at either end leave empty words
    at = np.asarray(found.indices)
    some = real[at] if len(names) else np.zeros(0, bool)
    text_of = np.repeat(np.arange(len(texts)), np.asarray(split.value_lengths()))[some]
    hashes = of_name[at[some]] if len(names) else np.zeros(0, np.uint64)
    counts = np.bincount(text_of, minlength=len(texts))
    ends = np.cumsum(counts)
    whole = _rolled(hashes, words) if len(hashes) >= words else np.zeros(0, np.uint64)
    sets = []
    for end, n in zip(ends.tolist(), counts.tolist()):
        mine = whole[end - n:end - words + 1] if n >= words else _rolled(hashes[end - n:end], n) if n else whole[:0]
        sets.append(np.unique(mine))
    return sets


def fingerprint(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, never 0; 0 is the name of the empty set."""
    return (xxhash.xxh3_64_intdigest(shingles.tobytes()) or 1) if len(shingles) else 0


def signed(numbers: list[int] | np.ndarray) -> pa.Array:
    return pa.array(np.asarray(numbers, np.uint64).view(np.int64))


def per_text(make: Callable[[pa.Array, list[np.ndarray]], pa.RecordBatch], words: int, text_at: int,
             id_at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that hands stretches of ids and sets to ``make``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch.column(text_at), STRETCH):
                yield make(batch.column(id_at)[part], shingle_sets(texts, words))
    return run
