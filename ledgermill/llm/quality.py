"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting visits one feature after the other and fits a shallow tree to
the gradient in the feature's bins; the trees of a feature add up to one lookup
table. The same is then done for the feature pairs that explain most of what is
left. A score is the sum of one entry of each table, passed through the logistic
function, so scoring is a bin search and an addition for each feature.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.common import ship

# At most so many labelled rows are learnt from: those first in the order of a
# hash of their ids. The only bound; scoring reads every row.
MAX_TRAINING_ROWS = 20_000

FEATURES = ("bytes", "words", "word_length", "longest_word", "upper", "digits", "symbols", "stops", "wide",
            "distinct_words", "top_word", "stutter", "lines", "line_length", "distinct_lines")
_UPPER, _LOWER = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91], _LOWER[97:123] = True, True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_WIDE = np.arange(256) >= 128
_SYMBOL = ~(_UPPER | _LOWER | _DIGIT | _BLANK | _WIDE)
_SYMBOL[[39, 44, 45, 46]] = False
_KINDS = np.stack([_UPPER, _LOWER, _DIGIT, _SYMBOL, _STOP, _WIDE]).astype(np.int64)


def features(text: bytes) -> list[float]:
    """What the model sees of a text, in the order of FEATURES; all 0 for an empty text."""
    size = len(text)
    if not size:
        return [0.0] * len(FEATURES)
    upper, lower, digit, symbol, stop, wide = _KINDS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    n = len(words)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    some = max(n, 1)
    return [math.log1p(size), math.log1p(n), sum(map(len, words)) / some, math.log1p(max(map(len, words), default=0)),
            upper / max(upper + lower, 1), digit / size, symbol / size, stop / some, wide / size,
            len(counts) / some, max(counts.values(), default=0) / some, sum(map(eq, words, words[1:])) / some,
            math.log1p(len(lines)), math.log1p(size / len(lines)), len(set(lines)) / len(lines)]


@dataclass
class Model:
    """Lookup tables; ``edges`` are the inner borders of the bins of each feature."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += t[np.searchsorted(e, x[:, j], "right")]
        bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.coarse)] if self.pairs else []
        for (i, j), g in zip(self.pairs, self.grids, strict=True):
            total += g[bins[i], bins[j]]
        return 1 / (1 + np.exp(-total))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_split(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of ordered bins; a gain of 0 if there is none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values by bin of a tree with a few leaves, grown by the best cut each time."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, at, k = max((*_best_split(g[a:b], h[a:b], ridge), k) for k, (a, b) in enumerate(parts))
        if gain <= 1e-9:
            break
        a, b = parts[k]
        parts[k:k + 1] = [(a, a + at), (a + at, b)]
    out = np.empty(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and values of a tree of depth 2 on a grid: one axis is cut, then each half along the other."""
    best = (-1.0, np.zeros_like(g))
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        _, at = _best_split(gg.sum(1), hh.sum(1), ridge)
        out, gain = np.zeros_like(gg), 0.0
        for a, b in ((0, at), (at, len(gg))) if at else ((0, len(gg)),):
            line_g, line_h = gg[a:b].sum(0), hh[a:b].sum(0)
            values = _tree(line_g, line_h, 2, ridge)
            out[a:b] = values
            gain += float((values ** 2 * (line_h + ridge)).sum())
        if gain > best[0]:
            best = (gain, out.T if turned else out)
    return best


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 200, pair_rounds: int = 60, pairs: int = 10, bins: int = 32,
        coarse: int = 8, rate: float = 0.1, ridge: float = 1.0) -> Model:
    """Fit to rows of FEATURES and labels 0/1; without both labels the smoothed share is all there is."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if len(y) == 0 or y.min() == y.max():
        return model
    width = x.shape[1]
    model.edges = [_edges(x[:, j], bins) for j in range(width)]
    model.coarse = [_edges(x[:, j], coarse) for j in range(width)]
    fine = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(fine[j], g, size), np.bincount(fine[j], h, size), 3, ridge)
            model.tables[j] += step
            total += step[fine[j]]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    sizes = [len(e) + 1 for e in model.coarse]

    def grids(i, j, g, h):
        cell, n = rough[i] * sizes[j] + rough[j], sizes[i] * sizes[j]
        return (np.bincount(cell, g, n).reshape(sizes[i], sizes[j]), np.bincount(cell, h, n).reshape(sizes[i], sizes[j]))

    g, h = slopes()
    ranked = sorted(combinations(range(width), 2), key=lambda p: -_grid_tree(*grids(*p, g, h), ridge)[0])
    model.pairs = ranked[:pairs]
    model.grids = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            step = rate * _grid_tree(*grids(i, j, *slopes()), ridge)[1]
            model.grids[k] += step
            total += step[rough[i], rough[j]]
    return model


def _features_of(texts: pa.Array) -> np.ndarray:
    rows = []
    for at in range(0, len(texts), 256):
        rows += [features(t or b"") for t in texts.slice(at, 256).to_pylist()]
    return np.array(rows, float).reshape(-1, len(FEATURES))


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """Learn from at most ``max_rows`` labelled rows that are not held out.

    Labels other than 0 and 1 and null ids are left aside; of several labels of
    an id the more frequent counts (1 on a tie). Each row of an id that ``docs`` has
    several times is learnt from; other columns of ``docs`` are not read.
    """
    ship(docs.sparkSession)
    known = (labels.where(f"`{label}` IN (0, 1) AND `{key}` IS NOT NULL").where(~held_out(key))
                   .groupBy(F.col(key).alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("y")))
    few = known.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    # max_rows rows of two numbers at most.
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").cast("binary").alias("t")).join(
        F.broadcast(few), "id")

    @F.arrow_udf("array<double>")
    def seen(texts: pa.Array) -> pa.Array:
        return pa.array(list(_features_of(texts)), pa.list_(pa.float64()))

    got = (rows.select("id", "y", seen("t").alias("x")).orderBy(F.xxhash64("id"), "id", "x").limit(max_rows)).collect()
    x = np.array([r["x"] for r in got], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], float))


def score(model: Model, text: str = "text") -> Column:
    """Score of each row's whole text, 0 to 1; null and empty texts get that of the empty text."""
    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_features_of(texts)), pa.float64())

    return scored(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))
