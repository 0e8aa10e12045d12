"""Personal data: fixed patterns, and a character-level BiLSTM-CRF that adds spans to theirs.

The patterns find each kind's base spans in the whole text. The tagger reads overlapping
windows of it, and its spans from all windows are reconciled over the document: spans
of one kind that overlap are one span, each must stand apart from letters and digits and
pass its kind's check, and of those that overlap the set with the highest total score stays. Base spans always stay; an added span
never touches one.

A span holds a digit, an ``@`` or a bracketed ``at``; that is part of every kind's check. So
windows without any of these are decoded only where spans of decoded windows reach into
them: these could be longer there. The result is that of decoding all windows.

Defined results
- NULL text: empty, no spans. NULL id: passes through. Repeated rows are judged alike.
- Empty table: empty result. Extra columns pass through ``redact``; ``find`` ignores them.
- Very long texts are read whole, window by window, with bounded memory per batch of windows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from walletscope.llm import tagger
from walletscope.llm.labelled_spans import examples
from walletscope.llm.worker import text_slices

#: Bytes of text handled at a time.
STRETCH = 1 << 20
KINDS = ("email", "ip", "card", "phone")
FOUND = "doc_id long, base array<struct<kind:string,start:long,end:long>>, added array<struct<kind:string,start:long,end:long>>"
Span = tuple[int, int, int]  # kind number, start, end (exclusive), in code points

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CUE = re.compile(r"[0-9@]|[\[(]at[\])]")
_NUMBER = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_NUMBER.findall(text))


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from their ``@`` so that long runs are read once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield 0, start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    spans = list(_emails(text))
    if _DIGIT.search(text):
        spans += [(1, *m.span()) for m in _IP.finditer(text) if _fits(1, m[0])]
        spans += [(2, *m.span()) for m in _CARD.finditer(text) if _fits(2, m[0])]
        spans += [(3, *m.span()) for m in _PHONE.finditer(text) if _fits(3, m[0])]
    return spans


def _fits(kind: int, found: str) -> bool:
    """The check that a span of a kind must pass, whoever finds it."""
    if kind == 0:
        return bool(re.fullmatch(r"[^\s@]+ ?(?:@|[\[(]at[\])]) ?[^\s@]+(?: ?(?:\.|[\[(]dot[\])]) ?[^\s@]+)*", found))
    if kind == 1:
        parts = [p.lstrip("0") or "0" for p in _NUMBER.findall(found)]
        return len(parts) == 4 and all(len(p) < 4 and int(p) < 256 for p in parts)
    digits = _digits(found)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 8 <= len(digits) <= 15


@dataclass(frozen=True)
class Windows:
    """Characters read at once, the step between windows, and windows decoded together."""

    width: int = 128
    step: int = 64
    at_once: int = 256


def symbol(char: str) -> int:
    """Number of a character for the tagger: ASCII by itself, others by class; 0 is padding."""
    code = ord(char)
    if 32 < code < 127:
        return code - 30
    return 1 if char.isspace() else 98 if char.isalpha() else 99


SYMBOLS = 100
_FIRST = np.array([symbol(chr(i)) for i in range(0x250)], np.int64)


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out = _FIRST[np.minimum(codes, 0x24f)]
    for i in np.flatnonzero(codes >= 0x250):
        out[i] = symbol(text[i])
    return out


@lru_cache(maxsize=2)
def trained(how: tagger.Training = tagger.Training(), windows: int = 2500, width: int = 96) -> dict[str, np.ndarray]:
    """The model of the labelled spans; tags are 0 outside, 2k+1 at the start of kind k, 2k+2 inside."""
    chars = np.zeros((windows, width), np.int64)
    tags = np.zeros((windows, width), np.int64)
    for i, (text, spans) in enumerate(examples(windows, width, how.seed)):
        chars[i, :len(text)] = symbols(text)
        for kind, a, b in spans:
            tags[i, a] = 2 * kind + 1
            tags[i, a + 1:b] = 2 * kind + 2
    return tagger.train(chars, tags, SYMBOLS, 2 * len(KINDS) + 1, how)


def _tagged(tags: np.ndarray, unary: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """Spans of one window's tags, with their gain over being outside."""
    inside = np.flatnonzero(tags)
    for run in np.split(inside, np.flatnonzero((np.diff(inside) > 1) | (tags[inside[1:]] % 2 == 1)
                                               | ((tags[inside[1:]] - 1) // 2 != (tags[inside[:-1]] - 1) // 2)) + 1):
        if len(run):
            gain = unary[run, tags[run]] - unary[run, 0]
            yield (int(tags[run[0]]) - 1) // 2, int(run[0]), int(run[-1]) + 1, float(gain.sum())


def reconcile(text: str, found: Sequence[tuple[int, int, int, float]], base: Sequence[Span]) -> list[Span]:
    """The added spans of a document from the spans of all its windows."""
    joined: list[list] = []
    for kind, a, b, score in sorted(found):
        if joined and joined[-1][0] == kind and a < joined[-1][2]:
            joined[-1][2:] = [max(b, joined[-1][2]), max(score, joined[-1][3])]
        else:
            joined.append([kind, a, b, score])
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, int)
    fit = []
    for kind, a, b, score in joined:
        i = int(np.searchsorted(starts, b, "left"))
        alone = not (text[a - 1:a].isalnum() or text[b:b + 1].isalnum())
        if score > 0 and alone and _CUE.search(text, a, b) and _fits(kind, text[a:b]) and not (i and reach[i - 1] > a):
            fit.append((b, a, kind, score))
    # weighted choice of spans that don't overlap
    fit.sort()
    ends = [b for b, *_ in fit]
    best: list[float] = [0.0]
    for i, (b, a, kind, score) in enumerate(fit):
        best.append(max(best[i], best[int(np.searchsorted(ends, a, "right"))] + score))
    chosen, i = [], len(fit)
    while i:
        b, a, kind, score = fit[i - 1]
        if best[i] == best[i - 1]:
            i -= 1
        else:
            chosen.append((kind, a, b))
            i = int(np.searchsorted(ends, a, "right"))
    return sorted(chosen)


def added_spans(texts: Sequence[str], bases: Sequence[Sequence[Span]], model: dict[str, np.ndarray],
                how: Windows = Windows()) -> list[list[Span]]:
    """What the tagger adds to the base spans of each text."""
    found: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
    asked: list[set[int]] = [set() for _ in texts]
    waiting: list[tuple[int, int]] = []

    def ask(i: int, first: int, last: int) -> None:
        new = [w for w in range(max(0, first), last + 1) if w not in asked[i]]
        asked[i].update(new)
        waiting.extend((i, w * how.step) for w in new)

    def flush() -> None:
        now = waiting[:how.at_once]
        del waiting[:how.at_once]
        chars = np.zeros((how.width, len(now)), np.int64)
        for j, (i, at) in enumerate(now):
            part = symbols(texts[i][at:at + how.width])
            chars[:len(part), j] = part
        tags, unary = tagger.decode(model, chars)
        for j, (i, at) in enumerate(now):
            length = min(how.width, len(texts[i]) - at)
            for k, a, b, s in _tagged(tags[:length, j], unary[:length, j]):
                found[i].append((k, at + a, at + b, s))
                # every window that a span reaches into
                ask(i, (at + a - how.width) // how.step + 1, (at + b - 1) // how.step)

    for i, text in enumerate(texts):
        last = -1
        for cue in _CUE.finditer(text):
            # every window that holds the whole cue
            first = max(last + 1, -(-max(0, cue.end() - how.width) // how.step))
            last = max(last, cue.start() // how.step)
            ask(i, first, last)
            while len(waiting) >= how.at_once:
                flush()
    while waiting:
        flush()
    return [reconcile(t, f, b) if f else [] for t, f, b in zip(texts, found, bases)]


def _finding(model: dict[str, np.ndarray], how: Windows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans: list[list[Span]]) -> pa.Array:
        return pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(s)] for s in spans], kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_slices(batch.column("text"), STRETCH):
                part = batch.slice(at.start, at.stop - at.start)
                base = [base_spans(t) for t in texts]
                added = added_spans(texts, base, model, how)
                yield pa.record_batch([part.column("doc_id"), listed(base), listed(added)], ["doc_id", "base", "added"])
    return run


def find(docs: DataFrame, model: dict[str, np.ndarray] | None = None, how: Windows = Windows(),
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and added spans (kind, start, end), both by kind and start."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_finding(model or trained(), how), FOUND)


def masked(text: str, spans: Sequence[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; overlapping ones become the first's."""
    if not spans:
        return text
    out, at, end = [], 0, 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= end:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = end = max(end, b)
    return "".join(out) + text[at:]


def _masking(model: dict[str, np.ndarray], how: Windows, text_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_col)
            for rows, texts in text_slices(batch.column(at), STRETCH):
                part = batch.slice(rows.start, rows.stop - rows.start)
                base = [base_spans(t) for t in texts]
                spans = [a + b for a, b in zip(base, added_spans(texts, base, model, how))]
                blank = part.column(at).is_null().to_pylist()
                clean = [None if n else masked(t, s) for t, s, n in zip(texts, spans, blank)]
                columns = [pa.array(clean, part.schema.field(at).type) if i == at else part.column(i)
                           for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)
    return run


def redact(docs: DataFrame, model: dict[str, np.ndarray] | None = None, how: Windows = Windows(),
           text_col: str = "text") -> DataFrame:
    """``docs`` with every span found in the text replaced by its kind."""
    return docs.mapInArrow(_masking(model or trained(), how, text_col), docs.schema)
