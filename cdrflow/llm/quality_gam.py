"""Quality classifier: a generalised additive model with pairwise interactions.

The model is a sum of look-up tables: one per feature over its bins, and one
per chosen pair of features over a coarse grid.  Tables are learned by cyclic
boosting: round after round, each feature in turn gets a shallow tree (at
most ``LEAVES`` leaves) fitted to the current gradients of its bins, shrunken
and added to its table; then the pairs with the largest remaining gain are
boosted in the same way with one cut per axis.  A score is one table look-up
per feature and pair, done for a whole batch at once.

Features are figures of the text alone.  They are computed on the executors;
only the figures of a bounded sample of labelled rows reach the driver.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import broadcast_arrays, fresh_name

#: Bound on the labelled documents that the model is fitted on.
TRAIN_ROWS = 20_000
BINS, GRID, LEAVES = 32, 8, 4
ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 150, 60, 10, 0.1
THRESHOLD = 0.7

FEATURES = (
    "log_chars", "log_words", "word_length", "word_length_spread", "distinct_words", "top_word",
    "repeated_neighbours", "distinct_pairs", "short_words", "long_words", "sentence_ends", "sentence_words",
    "capitalised", "log_lines", "line_words", "distinct_lines", "letters", "digits", "marks", "symbols",
    "upper", "non_ascii", "spaces", "distinct_chars", "alone_marks", "hapaxes",
)

_LETTER, _UPPER, _DIGIT, _MARK, _SYMBOL, _HIGH, _SPACE = range(7)
_BYTE_CLASS = np.full(256, _SYMBOL)
_BYTE_CLASS[128:] = _HIGH
for _c in range(128):
    _s = chr(_c)
    if _s.islower():
        _BYTE_CLASS[_c] = _LETTER
    elif _s.isupper():
        _BYTE_CLASS[_c] = _UPPER
    elif _s.isdigit():
        _BYTE_CLASS[_c] = _DIGIT
    elif _s.isspace():
        _BYTE_CLASS[_c] = _SPACE
    elif _s in ".,;:!?'\"()-":
        _BYTE_CLASS[_c] = _MARK


def features_of(text: str | None) -> list[float]:
    """One figure per name in ``FEATURES``; all 0 for null, empty and blank texts."""
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    data = np.frombuffer(text.encode(), np.uint8)
    by_byte = np.bincount(data, minlength=256)
    kinds = np.bincount(_BYTE_CLASS, weights=by_byte, minlength=7)
    size = len(data)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    once = sum(map((1).__eq__, counts.values()))
    lines = [x for x in text.split("\n") if x]
    ends = sum(map(str.endswith, words, [(".", "!", "?")] * n))
    near = sum(map(operator.eq, words, words[1:]))
    pairs = len(set(zip(words, words[1:]))) / (n - 1) if n > 1 else 1.0
    return [
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        float(lengths.mean()),
        float(lengths.std()),
        len(counts) / n,
        max(counts.values()) / n,
        near / n,
        pairs,
        float((lengths <= 3).mean()),
        float((lengths >= 10).mean()),
        ends / n,
        min(n / (ends + 1), 200.0),
        sum(w[0].isupper() for w in words) / n,
        float(np.log1p(len(lines))),
        min(n / max(len(lines), 1), 500.0),
        len(set(lines)) / max(len(lines), 1),
        (kinds[_LETTER] + kinds[_UPPER] + kinds[_HIGH]) / size,
        kinds[_DIGIT] / size,
        kinds[_MARK] / size,
        kinds[_SYMBOL] / size,
        kinds[_UPPER] / size,
        kinds[_HIGH] / size,
        kinds[_SPACE] / size,
        float((by_byte > 0).sum()) / np.sqrt(size),
        sum(not w[0].isalnum() and len(w) == 1 for w in words) / n,
        once / n,
    ]


def feature_rows(texts) -> np.ndarray:
    return np.array([features_of(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


@dataclass
class PairwiseGam:
    """Intercept, bin edges and tables; ``tables[j]`` has one value per bin."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.int64)
        for j, e in enumerate(self.edges):
            out[:, j] = np.searchsorted(e, x[:, j], side="right")
        return out

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        if not self.edges or not len(x):
            return total
        b = self.bins(x)
        for j, table in enumerate(self.tables):
            total += table[b[:, j]]
        for (i, j), grid in zip(self.pairs, self.grids):
            total += grid[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, leaves: int = LEAVES, ridge: float = 1.0) -> np.ndarray:
    """Step per bin of a greedy tree over ordered bins: best cut first."""
    value = lambda g, h: g / (h + ridge)
    g0, h0 = np.concatenate(([0.0], np.cumsum(grad))), np.concatenate(([0.0], np.cumsum(hess)))

    def best_cut(lo: int, hi: int) -> tuple[float, int]:
        cuts = np.arange(lo + 1, hi)
        if not len(cuts):
            return 0.0, lo
        gl, hl = g0[cuts] - g0[lo], h0[cuts] - h0[lo]
        gr, hr = g0[hi] - g0[cuts], h0[hi] - h0[cuts]
        whole = (g0[hi] - g0[lo]) ** 2 / (h0[hi] - h0[lo] + ridge)
        gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - whole
        k = int(gain.argmax())
        return float(gain[k]), int(cuts[k])

    parts = [(0, len(grad))]
    while len(parts) < leaves:
        (gain, cut), k = max((best_cut(*p), k) for k, p in enumerate(parts))
        if gain <= 1e-9:
            break
        lo, hi = parts.pop(k)
        parts += [(lo, cut), (cut, hi)]
    step = np.empty(len(grad))
    for lo, hi in parts:
        step[lo:hi] = value(g0[hi] - g0[lo], h0[hi] - h0[lo])
    return step


def _cross_tree(grad: np.ndarray, hess: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """(gain, step per cell) of the best tree with one cut on each axis."""
    g, h = np.zeros((GRID + 1, GRID + 1)), np.zeros((GRID + 1, GRID + 1))
    g[1:, 1:], h[1:, 1:] = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    a = np.arange(1, GRID)
    ll, lh = g[np.ix_(a, a)], h[np.ix_(a, a)]
    parts = [(ll, lh)]
    parts.append((g[a, -1][:, None] - ll, h[a, -1][:, None] - lh))
    parts.append((g[-1, a][None, :] - ll, h[-1, a][None, :] - lh))
    parts.append((g[-1, -1] - sum(p for p, _ in parts), h[-1, -1] - sum(q for _, q in parts)))
    gain = sum(p**2 / (q + ridge) for p, q in parts) - g[-1, -1] ** 2 / (h[-1, -1] + ridge)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    step = np.empty((GRID, GRID))
    low, top = slice(0, i + 1), slice(i + 1, GRID)
    left, right = slice(0, j + 1), slice(j + 1, GRID)
    for (rows, cols), (p, q) in zip(((low, left), (low, right), (top, left), (top, right)), parts):
        step[rows, cols] = p[i, j] / (q[i, j] + ridge)
    return float(gain[i, j]), step


def fit_gam(x: np.ndarray, y: np.ndarray) -> PairwiseGam:
    """Fit on figures ``x`` (rows x features) and labels ``y`` (0 or 1).

    Without rows the score is 0.5 everywhere; with labels of one kind only it
    is their smoothed share.
    """
    model = PairwiseGam()
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1.0)
    model.intercept = float(np.log(share / (1 - share))) if n else 0.0
    if not n or y.min() == y.max():
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)))
        size = len(model.edges[-1]) + 1
        model.tables.append(np.zeros(size))
        model.coarse.append(np.arange(size) * GRID // size)
    b = model.bins(x)
    margin = np.full(n, model.intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = gradients()
            step = RATE * _shallow_tree(
                np.bincount(b[:, j], g, len(table)), np.bincount(b[:, j], h, len(table))
            )
            table += step
            margin += step[b[:, j]]

    c = np.stack([model.coarse[j][b[:, j]] for j in range(x.shape[1])], 1)

    def cells(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = c[:, i] * GRID + c[:, j]
        shape = (GRID, GRID)
        return np.bincount(at, g, GRID * GRID).reshape(shape), np.bincount(at, h, GRID * GRID).reshape(shape)

    g, h = gradients()
    gains = [
        (_cross_tree(*cells(i, j, g, h))[0], i, j) for i in range(x.shape[1]) for j in range(i + 1, x.shape[1])
    ]
    model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    model.grids = [np.zeros((GRID, GRID)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), grid in zip(model.pairs, model.grids):
            g, h = gradients()
            step = RATE * _cross_tree(*cells(i, j, g, h))[1]
            grid += step
            margin += step[c[:, i], c[:, j]]
    return model


def _figures(text: Column) -> Column:
    def figures(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series(list(feature_rows(texts)), dtype=object)

    return F.pandas_udf(figures, "array<double>")(text)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality",
) -> PairwiseGam:
    """Fit on at most ``rows`` labelled documents that are not held out.

    The sample is the ids with the smallest hashes, so it does not depend on
    the order or layout of the tables.  Null labels are left out; of several
    labels for one id the majority counts (a tie is 1); of several texts for
    one id one counts.
    """
    wanted = (
        labels.filter(F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.avg(F.col(label_col).cast("double")).alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    found = (
        texts.join(F.broadcast(wanted), "id")  # at most ``rows`` ids
        .select("id", (F.col("y") >= 0.5).cast("int").alias("y"), _figures(F.col("t")).alias("x"))
        .groupBy("id")
        .agg(F.min(F.struct("y", "x")).alias("r"))
        .select("id", "r.*")
        .orderBy("id")
        .toPandas()
    )
    if not len(found):
        return fit_gam(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit_gam(np.stack(found["x"].to_numpy()), found["y"].to_numpy(np.float64))


def score_column(model: PairwiseGam, docs: DataFrame, text_col: str = "text") -> Column:
    shared = broadcast_arrays(docs.sparkSession, model)  # a few thousand numbers

    def score(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series(shared.value.score(feature_rows(texts)))

    return F.pandas_udf(score, "double")(F.col(text_col))


def score_documents(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
    **fit,
) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``.

    Null and empty texts are scored like any other (all figures 0).  Repeated
    rows get equal scores.  Other columns are ignored.  An empty table gives
    an empty result.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, **fit)
    scored = docs.select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score_column(model, docs, text_col).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **fit) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts.

    Without labels of both kinds it cannot tell documents apart and rejects none.
    """
    model = train(docs, labels, **fit)
    if not model.edges:
        return docs
    name = fresh_name(docs, "score")
    return docs.withColumn(name, score_column(model, docs)).filter(F.col(name) >= threshold).drop(name)
