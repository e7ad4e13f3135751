"""Toxicity by classifier chains.

Each category has a linear (logistic) model over the words of a document, and
every model but the first also sees the probabilities of the categories before
it.  For training these are out-of-fold predictions: a row's earlier probability
comes from models that have not seen the row, as it will at scoring time.

A row's features are its distinct words, their first three to six characters
(made-up and inflected forms share a stem), and three coarse measures of the
text.  Only features that go with a category far beyond chance are kept, so a
long text gathers no noise from thousands of neutral words.

Training takes at most ``max_labelled`` labelled rows, those with the smallest
hash of their id: a bounded sample, sent to one task.  The models are at most
``max_features`` weights a category and travel to the tasks that score; the
documents are scored where they are, without a shuffle.

Edge cases: null or empty text is scored by the measures alone; rows whose label
is null are not trained on; a category with only one outcome in the sample gets
its share as constant probability (0 without any labelled row); several labels
for one id count by their largest value; rows that share an id are scored each;
extra columns are passed on by ``without_toxic`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from acqlens.llm.common import U64, remembered, stored, stretches, utf8, working

CATEGORIES = ("low_quality", "toxic")
_BREAKS = bytes(c if c >= 128 or 48 <= c < 58 or 97 <= c < 123 else c + 32 if 65 <= c < 91 else 32
                for c in range(256))
_PLAIN = bytes(c for c in range(256) if c >= 128 or 48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123
               or c in b" \t\n\x0b\x0c\r")


_hash = xxhash.xxh3_64_intdigest  # features are known by their hashes only


def distinct_words(text: bytes) -> tuple[set[bytes], list[int]]:
    """The distinct words and the measures of a text: share of other characters,
    share of distinct words, mean length of a word, in coarse steps."""
    found, n = set(), 0
    for part in stretches(text):
        split = part.translate(_BREAKS).split()
        found.update(split)
        n += len(split)
    odd = len(text.translate(None, _PLAIN)) / max(1, len(text))
    return found, [_hash(b"# odd %d" % min(10, int(40 * odd))),
                   _hash(b"# distinct %d" % int(10 * len(found) / max(1, n))),
                   _hash(b"# length %d" % min(10, int(sum(map(len, found)) / max(1, len(found)))))]


def word_features(word: bytes) -> tuple[int, ...]:
    """The word itself and the stems of 3 to 6 characters (marked by ``*``)."""
    try:
        text = word.decode()
    except UnicodeDecodeError:
        return (_hash(word),)
    return (_hash(word), *(_hash(text[:k].encode() + b"*") for k in range(3, 7) if len(text) >= k))


class _Features(dict):
    """word -> its features, remembered for up to 50,000 words."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= 50_000:
            self.clear()
        got = self[word] = word_features(word)
        return got


_FEATURES = remembered("toxicity", _Features())


def features(text: bytes) -> set[int]:
    found, out = distinct_words(text)
    out = set(out)
    for w in found:
        out.update(_FEATURES[w])
    return out


class Chain:
    """Vocabulary, and per category weights, weights of earlier categories, bias."""

    def __init__(self, vocabulary: list[int], weights: np.ndarray, earlier: np.ndarray,
                 bias: np.ndarray):
        self.vocabulary, self.weights, self.earlier, self.bias = vocabulary, weights, earlier, bias
        self.place = {f: i for i, f in enumerate(vocabulary)}
        self.known: dict[bytes, tuple[int, ...]] = remembered("toxicity", {})

    def _places(self, word: bytes) -> tuple[int, ...]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            place = self.place
            got = self.known[word] = tuple(place[f] for f in word_features(word) if f in place)
        return got

    def probabilities(self, text: bytes) -> list[float]:
        found, measures = distinct_words(text)
        at = {self.place[m] for m in measures if m in self.place}
        at.update(*map(self._places, found))
        sums = self.weights[sorted(at)].sum(axis=0) + self.bias if at else self.bias
        out: list[float] = []
        for c in range(len(self.bias)):
            z = float(sums[c]) + sum(p * v for p, v in zip(out, self.earlier[c]))
            out.append(float(_sigmoid(np.float64(z))))
        return out


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Sparse 0/1 rows, in order by row and by feature."""

    def __init__(self, row: np.ndarray, feature: np.ndarray, n: int, width: int):
        self.n, self.width, self.feature = n, width, feature
        self.some_rows, self.row_starts = np.unique(row, return_index=True)
        order = np.argsort(feature, kind="stable")
        self.row = row[order]
        self.some_features, self.feature_starts = np.unique(feature[order], return_index=True)

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.feature):
            out[self.some_rows] = np.add.reduceat(w[self.feature], self.row_starts)
        return out

    def summed(self, by_row: np.ndarray) -> np.ndarray:
        """Per feature the sum of ``by_row`` over the rows that have it."""
        out = np.zeros(self.width)
        if len(self.row):
            out[self.some_features] = np.add.reduceat(by_row[self.row], self.feature_starts)
        return out


def _fit(rows: _Rows, extra: np.ndarray, y: np.ndarray, use: np.ndarray, ridge: float, steps: int) -> np.ndarray:
    """Ridge logistic regression on the rows in ``use``, with dense columns
    ``extra``, by accelerated gradient steps scaled per feature."""
    n = rows.n
    dense = np.column_stack([extra, np.ones(n)])
    w, v = np.zeros(rows.width), np.zeros(dense.shape[1])
    # a diagonal bound of the curvature makes rare and frequent features move alike
    spread = np.where(use, rows.times(np.ones(rows.width)) + dense.shape[1], 0.0)
    scale = 0.25 * rows.summed(spread) + ridge
    scale_v = 0.25 * (dense ** 2 * spread[:, None]).sum(axis=0) + 1e-6
    aw, av, t = w, v, 1.0
    for _ in range(steps):
        slope = np.where(use, _sigmoid(rows.times(aw) + dense @ av) - y, 0.0)
        new_w = aw - (rows.summed(slope) + ridge * aw) / scale
        new_v = av - (dense.T @ slope) / scale_v
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        aw, av = new_w + (t - 1) / t_next * (new_w - w), new_v + (t - 1) / t_next * (new_v - v)
        w, v, t = new_w, new_v, t_next
    return np.concatenate([w, v])


def train_chain(texts: list[bytes], labels: np.ndarray, fold: np.ndarray, folds: int,
                max_features: int, z_least: float = 4.5, ridge: float = 1.0,
                steps: int = 120) -> Chain:
    """``labels``: rows x categories of 0/1; ``fold``: each row's fold number."""
    n, k = labels.shape if len(labels) else (0, labels.shape[1])
    found = [np.fromiter(f, U64, len(f)) for f in map(features, texts)]
    if not n or not any(map(len, found)):
        return Chain([], np.zeros((0, k)), np.zeros((k, k)), np.full(k, -30.0))
    row, value = np.repeat(np.arange(n), [len(f) for f in found]), np.concatenate(found)
    del found
    names, df = np.unique(value, return_counts=True)
    names, df = names[df >= 5], df[df >= 5]
    feature = np.searchsorted(names, value)
    feature[feature == len(names)] = 0
    keep = names[feature] == value if len(names) else np.zeros(len(value), bool)
    row, feature = row[keep], feature[keep]
    strength = np.zeros(len(names))
    for c in range(k):
        p = labels[:, c].mean()
        hits = np.bincount(feature, weights=labels[row, c], minlength=len(names))
        strength = np.maximum(strength, np.abs(hits - df * p) / np.sqrt(df * max(p * (1 - p), 1e-9)))
    good = np.lexsort((names, -strength))[:max_features]
    good = good[strength[good] >= z_least]
    new = np.full(len(names), -1)
    new[good] = np.arange(len(good))
    order = new[feature]
    row, order = row[order >= 0], order[order >= 0]
    width, everything = len(good), np.ones(n, bool)
    rows = _Rows(row, order, n, width)
    weights, earlier, bias = np.zeros((width, k)), np.zeros((k, k)), np.zeros(k)
    out_of_fold = np.zeros((n, 0))
    for c in range(k):
        y = labels[:, c].astype(float)
        if y.min() == y.max():
            bias[c] = 30.0 if y[0] else -30.0
            out_of_fold = np.column_stack([out_of_fold, y])
            continue
        fit = _fit(rows, out_of_fold, y, everything, ridge, steps)
        weights[:, c], bias[c] = fit[:width], fit[-1]
        earlier[c, :c] = fit[width:-1]
        if c < k - 1:
            p = np.zeros(n)
            for f in range(folds):
                held = fold == f
                part = _fit(rows, out_of_fold, y, ~held, ridge, steps)
                z = rows.times(part[:width]) + np.column_stack([out_of_fold, np.ones(n)]) @ part[width:]
                p[held] = _sigmoid(z[held])
            out_of_fold = np.column_stack([out_of_fold, p])
    return Chain(names[good].tolist(), weights, earlier, bias)


def fit_chain(docs: DataFrame, labelled: DataFrame, categories: Sequence[str] = CATEGORIES,
              max_labelled: int = 12_000, max_features: int = 20_000, folds: int = 4,
              id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """``labelled``: ``id_col`` and one 0/1 column a category."""
    order = F.xxhash64(F.col(id_col).cast("long"))
    sample = (labelled.select(F.col(id_col).cast("long").alias("llm_id"), *categories)
              .dropna().groupBy("llm_id").agg(*[F.max(c).cast("int").alias(c) for c in categories])
              .orderBy(F.xxhash64("llm_id"), "llm_id").limit(max_labelled))
    sample = stored(sample, "labelled")
    # at most max_labelled rows of an id and its labels
    rows = docs.select(F.col(id_col).cast("long").alias("llm_id"), F.col(text_col).alias("llm_text"),
                       order.alias("llm_order")).join(F.broadcast(sample), "llm_id")
    rows = stored(rows.groupBy("llm_id", "llm_order", *categories).agg(F.max("llm_text").alias("llm_text"))
                  .select("llm_order", "llm_text", *categories), "training").coalesce(1)
    k = len(categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("toxicity")
        got = sorted((o, t, y) for b in batches for o, t, *y in zip(
            b.column(0).to_pylist(), utf8(b.column(1)), *(b.column(2 + c).to_pylist() for c in range(k))))
        labels = np.array([g[2] for g in got], float).reshape(len(got), k)
        chain = train_chain([g[1] for g in got], labels, np.arange(len(got)) % folds, folds, max_features)
        names = [*np.array(chain.vocabulary, U64).view(np.int64).tolist(), None]  # last: the bias
        yield pa.RecordBatch.from_arrays([
            pa.array(names, pa.int64()),
            pa.array([*chain.weights.tolist(), chain.bias.tolist()], pa.list_(pa.float64())),
            pa.array([chain.earlier.reshape(-1).tolist()] * len(names), pa.list_(pa.float64()))],
            ["name", "weights", "earlier"])

    model = rows.mapInArrow(run, "name long, weights array<double>, earlier array<double>").collect()
    if not model:  # no partition at all
        return Chain([], np.zeros((0, k)), np.zeros((k, k)), np.full(k, -30.0))
    body = [r for r in model if r["name"] is not None]
    last = next(r for r in model if r["name"] is None)
    return Chain([r["name"] % (1 << 64) for r in body],
                 np.array([r["weights"] for r in body]).reshape(len(body), k),
                 np.array(last["earlier"]).reshape(k, k), np.array(last["weights"]))


def score(docs: DataFrame, chain: Chain, categories: Sequence[str] = CATEGORIES,
          text_col: str = "text") -> Column:
    """The probabilities of the categories, as an array column of ``docs``."""
    parts = (chain.vocabulary, chain.weights, chain.earlier, chain.bias)
    sent = docs.sparkSession.sparkContext.broadcast(parts)
    made: list[Chain] = []

    @F.arrow_udf("array<double>")
    def probabilities(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        working("toxicity")
        if not made:
            made.append(Chain(*sent.value))
        for column in texts:
            yield pa.array([made[0].probabilities(t) for t in utf8(column)], pa.list_(pa.float64()))

    return probabilities(F.col(text_col))


def labelled_categories(labels: DataFrame) -> DataFrame:
    """The given labels as the chain's categories: low quality first, then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


def toxicity_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.4) -> DataFrame:
    """Per document: the probability of each category and the verdict."""
    chain = fit_chain(docs, labelled_categories(labels))
    p = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(docs, chain).alias("p"))
    return p.select("doc_id", *[F.round(F.col("p")[i], 6).alias(f"p_{c}") for i, c in enumerate(CATEGORIES)],
                    (F.col("p")[len(CATEGORIES) - 1] >= threshold).alias("rejected"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.4) -> DataFrame:
    """``docs`` without those that the chain's last category rejects."""
    chain = fit_chain(docs, labelled_categories(labels))
    return docs.where(score(docs, chain)[len(CATEGORIES) - 1] < threshold)
