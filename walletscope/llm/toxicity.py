"""Toxicity by a classifier chain of linear models.

The categories are judged one after the other. Each has a logistic regression over hashed
features of the document's distinct tokens (the token itself and its character n-grams
between word marks), and over the log odds of the categories before it. A later model
learns from out-of-fold odds of the earlier ones, so it meets them in training as it will
in use. Of the features, a model keeps those that speak for its category.

Training reads a bounded sample of the labelled documents (``Chain.sample`` rows, by the
order of a hash); scoring reads every whole text.

Defined results
- NULL text: empty, judged by the intercepts. NULL id: passes through.
- Repeated rows are judged alike. Several labels for one id: the largest of each counts.
- NULL label: the row does not teach that category. A category without labelled rows of both
  sides gets probability 0, so it rejects nothing. Empty table: empty result.
- Extra columns pass through ``judge`` and ``keep_clean``, except those named like outputs.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from walletscope.llm.worker import kept, text_slices
from walletscope.plans.settle import settle

#: Bytes of text handled at a time.
STRETCH = 1 << 19
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+")


@dataclass(frozen=True)
class Chain:
    """What is learned and how; ``sample`` bounds the labelled rows that training reads."""

    sample: int = 8000
    folds: int = 4
    width: int = 1 << 18     # hashed features
    gram: int = 5
    support: int = 4         # positive documents that a kept feature is in
    evidence: float = 1.5    # log ratio of its rates in positive and negative documents, at least
    l2: float = 0.5
    threshold: float = 0.5


def token_features(token: str, how: Chain) -> list[int]:
    marked = f"^{token}$".encode()
    grams = (marked[i:i + how.gram] for i in range(len(marked) - how.gram + 1))
    return [h % how.width for h in {zlib.crc32(marked, 7), *map(zlib.crc32, grams)}]


def tokens(text: str) -> set[str]:
    return set(_TOKEN.findall(text.lower()))


def _featured(how: Chain, ys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (text, id hash, labels ...) to (fold, features as int32 bytes, counts as int32 bytes, labels ...)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch.column(0), STRETCH):
                rows = []
                for text in texts:
                    found = [f for t in tokens(text) for f in token_features(t, how)]
                    rows.append(np.unique(np.array(found, np.int32), return_counts=True))
                yield pa.record_batch([
                    batch.column(1)[part], pa.array([a.astype("<i4").tobytes() for a, _ in rows], pa.binary()),
                    pa.array([n.astype("<i4").tobytes() for _, n in rows], pa.binary()),
                    *(batch.column(2 + i)[part] for i in range(ys))],
                    ["fold", "features", "counts", *(f"y{i}" for i in range(ys))])
    return run


@dataclass
class Link:
    """One model of the chain: weights of features, weights of the earlier odds, intercept."""

    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def odds(self, feature_sums: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return feature_sums + earlier @ self.earlier + self.intercept


@dataclass
class Examples:
    """Sparse rows of feature counts."""

    row: np.ndarray
    feature: np.ndarray
    count: np.ndarray
    rows: int

    def of(self, keep: np.ndarray) -> Examples:
        number = np.cumsum(keep) - 1
        some = keep[self.row]
        return Examples(number[self.row[some]], self.feature[some], self.count[some], int(keep.sum()))

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature] * self.count, self.rows)

    def documents(self, width: int) -> np.ndarray:
        return np.bincount(self.feature, minlength=width)


#: Earlier odds are cut off here, on both sides, in training and in use.
ODDS_LIMIT = 10.0


def _log_ratio(pos: np.ndarray, neg: np.ndarray, positives: np.ndarray, negatives: np.ndarray) -> np.ndarray:
    return np.log((pos + 0.5) / (positives + 1)) - np.log((neg + 0.5) / (negatives + 1))


def _evidence(x: Examples, y: np.ndarray, how: Chain) -> np.ndarray:
    """Log ratio of a feature's rates in positive and negative documents, 0 for features not kept."""
    pos, neg = x.of(y).documents(how.width), x.of(~y).documents(how.width)
    ratio = _log_ratio(pos, neg, y.sum(), (~y).sum())
    return np.where((pos >= how.support) & (ratio >= how.evidence), np.minimum(ratio, 4.0), 0.0)


def fit(x: Examples, earlier: np.ndarray, y: np.ndarray, how: Chain, steps: int = 200) -> Link | None:
    """Logistic regression by Adam; features are scaled by their evidence."""
    if y.all() or not y.any():
        return None
    scale = _evidence(x, y, how)
    used = np.flatnonzero(scale)
    number = np.zeros(how.width, np.int64)
    number[used] = np.arange(len(used))
    kept = scale[x.feature] > 0
    row, col, value = x.row[kept], number[x.feature[kept]], x.count[kept] * scale[x.feature[kept]]
    size = len(used) + earlier.shape[1] + 1
    w, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    penalty = np.full(size, how.l2 / len(y))
    penalty[-1] = 0.0
    for step in range(1, steps + 1):
        z = np.bincount(row, w[col] * value, len(y)) + earlier @ w[len(used):-1] + w[-1]
        miss = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        grad = np.concatenate([np.bincount(col, miss[row] * value, len(used)), earlier.T @ miss, [miss.sum()]]) + penalty * w
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    weights = np.zeros(how.width)
    weights[used] = w[:len(used)] * scale[used]
    return Link(weights, w[len(used):-1], float(w[-1]))


def fit_chain(x: Examples, labels: np.ndarray, fold: np.ndarray, how: Chain) -> list[Link | None]:
    """A model per column of ``labels`` (1, 0, or NaN for unknown), each fed the odds of those before."""
    chain: list[Link | None] = []
    odds = np.zeros((x.rows, 0))
    for y in labels.T:
        known = ~np.isnan(y)
        chain.append(fit(x.of(known), odds[known], y[known] > 0, how))
        unseen = np.full(x.rows, -ODDS_LIMIT)
        for k in range(how.folds):
            learn, rest = known & (fold != k), fold == k
            link = fit(x.of(learn), odds[learn], y[learn] > 0, how)
            if link and rest.any():
                unseen[rest] = link.odds(x.of(rest).sums(link.weights), odds[rest])
        odds = np.column_stack([odds, np.clip(unseen, -ODDS_LIMIT, ODDS_LIMIT)])
    return chain


@dataclass
class Model:
    categories: tuple[str, ...]
    chain: list[Link | None]
    how: Chain


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], how: Chain = Chain(),
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A chain over ``categories``: a 0/1 expression over ``labels`` each, in the order of the chain."""
    ys = [y.cast("int").alias(f"y{i}") for i, y in enumerate(categories.values())]
    known = labels.select(F.col(id_col).alias("_id"), *ys).filter("_id IS NOT NULL")
    known = known.groupBy("_id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(ys))))
    order = F.xxhash64("_id", F.lit(11))
    picked = known.orderBy(order, "_id").limit(how.sample)  # the documented bound
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(picked), "_id")
    rows = rows.select("_text", F.pmod(order, F.lit(how.folds)).cast("int").alias("fold"),
                       *(f"y{i}" for i in range(len(ys))))
    schema = T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("features", T.BinaryType()),
                           T.StructField("counts", T.BinaryType()),
                           *(T.StructField(f"y{i}", T.IntegerType()) for i in range(len(ys)))])
    examples = settle(rows.mapInArrow(_featured(how, len(ys)), schema), "toxicity-sample")

    # features that could speak for a category, with some room for the folds; few of all
    has = np.zeros((len(ys), 2, how.width), np.int32)
    rows_of = np.zeros((len(ys), 2))
    for r in examples.toLocalIterator():
        found = np.frombuffer(r["features"], "<i4")
        for i in range(len(ys)):
            if (y := r[f"y{i}"]) is not None:
                has[i, int(y > 0), found] += 1
                rows_of[i, int(y > 0)] += 1
    ratio = _log_ratio(has[:, 1], has[:, 0], rows_of[:, 1:], rows_of[:, :1])
    told = ((has[:, 1] >= how.support) & (ratio >= how.evidence - 0.7)).any(axis=0)
    row, feature, count, fold, y = [], [], [], [], []
    for n, r in enumerate(examples.toLocalIterator()):
        found, counts = np.frombuffer(r["features"], "<i4"), np.frombuffer(r["counts"], "<i4")
        some = told[found]
        row.append(np.full(int(some.sum()), n, np.int32))
        feature.append(found[some])
        count.append(counts[some])
        fold.append(r["fold"])
        y.append([np.nan if r[f"y{i}"] is None else float(r[f"y{i}"]) for i in range(len(ys))])
    if not y:
        return Model(tuple(categories), [None] * len(ys), how)
    x = Examples(np.concatenate(row), np.concatenate(feature),
                 np.concatenate(count).astype(np.float32), len(y))
    return Model(tuple(categories), fit_chain(x, np.array(y), np.array(fold), how), how)


class Scorer:
    """Probabilities of texts; a token's part in each model's sum is worked out once."""

    kept_tokens, kept_chars = 150_000, 1 << 22

    def __init__(self, model: Model) -> None:
        self.model, self.links = model, [link for link in model.chain if link]
        self.weights = np.stack([link.weights for link in self.links]) if self.links else np.zeros((0, model.how.width))
        self.parts: dict[str, tuple[float, ...] | None] = {}
        self.chars = 0

    def _learn(self, new: list[str]) -> None:
        """Work out the parts of new tokens; None where no model has a weight for the token."""
        features = [token_features(t, self.model.how) for t in new]
        lengths = np.fromiter(map(len, features), np.int64, len(features))
        flat = np.fromiter((f for fs in features for f in fs), np.int64, int(lengths.sum()))
        sums = np.add.reduceat(self.weights[:, flat], np.cumsum(lengths) - lengths, axis=1).T
        some = sums.any(axis=1)
        self.chars += sum(map(len, new))
        self.parts.update(dict.fromkeys(new))
        self.parts.update((new[i], tuple(sums[i].tolist())) for i in np.flatnonzero(some))

    def probabilities(self, texts: Sequence[str]) -> np.ndarray:
        sums = np.zeros((len(texts), len(self.links)))
        if len(self.parts) > self.kept_tokens or self.chars > self.kept_chars:
            self.parts, self.chars = {}, 0
        by_text = [tokens(text) for text in texts]
        parts = self.parts
        if new := list(set().union(*by_text) - parts.keys()):
            self._learn(new)
        for i, found in enumerate(by_text):
            told = [p for p in map(parts.__getitem__, found) if p]
            if told:
                sums[i] = [sum(sorted(column)) for column in zip(*told)]  # the same sum whatever the order
        odds, chances, k = np.zeros((len(texts), 0)), [], 0
        for link in self.model.chain:
            z = link.odds(sums[:, k], odds) if link else np.full(len(texts), -np.inf)
            k += link is not None
            chances.append(1 / (1 + np.exp(-np.clip(z, -700, 700))) if link else np.zeros(len(texts)))
            odds = np.column_stack([odds, np.clip(z, -ODDS_LIMIT, ODDS_LIMIT)])
        return np.column_stack(chances) if chances else np.zeros((len(texts), 0))


def _judging(model: Model, text_at: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept(("toxicity", name), lambda: Scorer(model))
        for batch in batches:
            for run_of, texts in text_slices(batch.column(text_at), STRETCH):
                part = batch.slice(run_of.start, run_of.stop - run_of.start)
                chances = scorer.probabilities(texts)
                columns = [*part.columns, *(pa.array(c, pa.float64()) for c in chances.T)]
                yield pa.RecordBatch.from_arrays(columns, names)
    return run


def judge(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with p_<category> for each category and, for each, whether it reaches the threshold."""
    outputs = [f"p_{c}" for c in model.categories]
    docs = docs.drop(*outputs, *model.categories)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(o, T.DoubleType()) for o in outputs)])
    judged = docs.mapInArrow(_judging(model, docs.columns.index(text_col), schema.names), schema)
    return judged.withColumns({c: F.col(f"p_{c}") >= model.how.threshold for c in model.categories})


def keep_clean(docs: DataFrame, model: Model, category: str, text_col: str = "text") -> DataFrame:
    """The documents that the category does not reject, with their own columns."""
    judged = judge(docs.select(F.struct(*docs.columns).alias("_doc"), F.col(text_col).alias("_text")), model, "_text")
    return judged.filter(~F.col(category)).select("_doc.*")
