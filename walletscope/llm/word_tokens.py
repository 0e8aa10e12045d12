"""Ids of a word-level BPE tokenizer, encoding each distinct word once.

A ``tokenizers`` file whose pre-tokenizer splits texts into words gives the same ids for
a text as for its words one by one. Plain words are met again and again, so each distinct
chunk between blanks is encoded once per stretch of texts, and each worker keeps the ids of
common chunks and words, up to a fixed number, and asks the tokenizer for the others only. Texts with characters whose normal form or class depends on more than the
character itself, and texts that hold an added token such as ``<|endoftext|>``, go through
the tokenizer whole, which gives an added token its own id.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from walletscope.llm.bpe import Gather, Numbered, safe_cut
from walletscope.llm.worker import kept, text_slices

#: Characters for which normalising, lower-casing and splitting agree with the tokenizer's own.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: Distinct chunks, and words, kept by one worker, and characters and ids of either; characters of text
#: handled at a time; words asked for at a time.
KEPT, KEPT_CHARS, STRETCH, ASKED = 150_000, 1 << 22, 3 << 19, 4000


class Memory:
    """Ids of strings, up to a fixed number and length of them: those that come first, which are the common ones."""

    def __init__(self, most: int, chars: int = KEPT_CHARS) -> None:
        self.most, self.chars, self.number, self.ids = most, chars, {}, Gather(np.uint32)

    def find(self, strings: list[str]) -> np.ndarray:
        """Row of each string in ``ids``, -1 where it is not kept."""
        return np.fromiter(map(self.number.get, strings, repeat(-1)), np.int64, len(strings))

    def keep(self, strings: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        size = np.cumsum(np.fromiter(map(len, strings), np.int64, len(strings)) + lengths)
        room = min(self.most - len(self.number), int(np.searchsorted(size, self.chars, "right")))
        if room > 0:
            strings, lengths = strings[:room], lengths[:room]
            self.chars -= int(size[room - 1])
            self.number.update(zip(strings, range(self.ids.rows, self.ids.rows + len(strings))))
            self.ids.extend(ids[:int(lengths.sum())], lengths)


def _joined(memory: Memory, row: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> Gather:
    """All strings' ids in their order: kept ones by their row, the others as given."""
    both, kept_rows = Gather(np.uint32), row >= 0
    both.extend(*memory.ids.take(row[kept_rows]))
    both.extend(ids, lengths)
    order = np.empty(len(row), np.int64)
    order[kept_rows] = np.arange(int(kept_rows.sum()))
    order[~kept_rows] = np.arange(int(kept_rows.sum()), len(row))
    both.start[:len(row)], both.length[:len(row)] = both.start[order], both.length[order]
    return both


class WordCoder:
    def __init__(self, path: str, kept: int = KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.path, self.whole = path, None  # the tokenizer as it is, loaded when a text needs it
        # words come normalised and split, with blanks between them
        self.words = Tokenizer.from_file(path)
        self.words.encode_special_tokens = True
        self.words.normalizer = None
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        added = self.words.get_added_tokens_decoder().values()
        self.added = [t.content for t in added if not t.normalized]
        self.lowered = [t.content.lower() for t in added if t.normalized]  # met in normalised text
        vocabulary = self.words.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.chunks, self.parts = Memory(kept), Memory(kept)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and how many each has."""
        lines = [" ".join(words[i:i + ASKED]) for i in range(0, len(words), ASKED)]
        found = self.words.encode_batch_fast(lines, add_special_tokens=False)
        flat = np.concatenate([np.zeros(0, np.int64), *(np.array(e.ids, np.int64) for e in found)])
        ends = np.flatnonzero(self.ends[flat]) + 1  # a word's last token says so
        return flat, np.diff(ends, prepend=0)

    def _known(self, memory: Memory, strings: list[str], encode: Callable, worth: np.ndarray | None = None) -> Gather:
        """Ids of distinct strings in their order, from the memory or by ``encode``; new ones that are ``worth`` it stay."""
        row = memory.find(strings)
        missing = np.flatnonzero(row < 0)
        new = [strings[i] for i in missing]
        ids, lengths = encode(new)
        found = _joined(memory, row, ids, lengths)
        if worth is None:
            memory.keep(new, ids, lengths)
        else:
            mine = np.flatnonzero(worth[missing])
            memory.keep([new[i] for i in mine], *found.take(missing[mine]))
        return found

    def _by_words(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, runs of characters without blanks, by way of their words."""
        number = Numbered()
        words = [_WORDS.findall(c) for c in map(str.lower, chunks)]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        ids, lengths = self._known(self.parts, number.new, self._encoded).take(at)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(counts)] if len(counts) else counts
        return ids, np.diff(ends, prepend=0)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        chunks = split.flatten().dictionary_encode()
        at = np.asarray(chunks.indices)
        distinct = chunks.dictionary.to_pylist()
        often = np.bincount(at, minlength=len(distinct)) > 1
        ids, lengths = self._known(self.chunks, distinct, self._by_words, often).take(at)
        cuts = np.cumsum([0, *np.asarray(split.value_lengths()).tolist()])
        ends = np.concatenate([[0], np.cumsum(lengths)])[cuts]
        return [ids[a:b] for a, b in zip(ends, ends[1:])]

    def _holds_added(self, text: str) -> bool:
        return any(a in text for a in self.added) or any(a in text.lower() for a in self.lowered)

    def _other(self, text: str) -> np.ndarray:
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [_PLAIN.fullmatch(t) is not None and not self._holds_added(t) for t in texts]
        easy = iter(self._plain([t for t, p in zip(texts, plain) if p]))
        return [next(easy) if p else self._other(t) for t, p in zip(texts, plain)]

    def encode_long(self, text: str) -> np.ndarray:
        parts, at = [np.zeros(0, np.uint32)], 0
        while at < len(text):
            cut = safe_cut(text, at + STRETCH)
            parts += self.encode([text[at:cut]])
            at = cut
        return np.concatenate(parts)

    def encode_all(self, texts: pa.Array) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """Runs of a batch's texts of bounded size with their ids."""
        for part, some in text_slices(texts, STRETCH):
            yield part, [self.encode_long(some[0])] if len(some) == 1 else self.encode(some)


def coder(path: str) -> WordCoder:
    """One coder for the tasks of a Python worker."""
    return kept(("words", path), lambda: WordCoder(path))
