"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes through the features in turn and adds a shallow tree of one
feature at a time; what the trees of a feature say is summed into one table
over the feature's bins. Pairs of features that explain most of what is left
get tables of their own. A score is a sum of table entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from starmill.llm.common import map_arrow

#: Classes of the bytes of a UTF-8 text.
_UPPER, _LOWER, _DIGIT, _BLANK, _LINE, _STOP, _COMMA, _SIGN, _HIGH = range(9)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _SIGN, np.uint8)
    for i in range(256):
        c = chr(i)
        if i >= 128:
            kinds[i] = _HIGH
        elif c.isalpha():
            kinds[i] = _UPPER if c.isupper() else _LOWER
        elif c.isdigit():
            kinds[i] = _DIGIT
        elif c in "\n\r":
            kinds[i] = _LINE
        elif c.isspace():
            kinds[i] = _BLANK
        elif c in ".!?":
            kinds[i] = _STOP
        elif c in ",;:'\"-()":
            kinds[i] = _COMMA
    return kinds


FEATURES = (
    "log_words",
    "word_length",
    "upper_share",
    "digit_share",
    "sign_share",
    "stop_rate",
    "comma_rate",
    "distinct_words",
    "repeated_words",
    "distinct_lines",
    "line_words",
    "signed_words",
    "longest_word",
    "upper_words",
)


def features_of(text: bytes | None, kinds: np.ndarray) -> list[float]:
    """Features of a whole text; an empty one has zeros."""
    words = (text or b"").split()
    if not words:
        return [0.0] * len(FEATURES)
    n = np.bincount(kinds[np.frombuffer(text, np.uint8)], minlength=9)
    count, inked = len(words), max(1, int(n.sum() - n[_BLANK] - n[_LINE]))
    lengths = list(map(len, words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    letters = max(1, int(n[_UPPER] + n[_LOWER]))
    return [
        float(np.log1p(count)),
        inked / count,
        n[_UPPER] / letters,
        n[_DIGIT] / inked,
        n[_SIGN] / inked,
        n[_STOP] / count,
        n[_COMMA] / count,
        len(set(words)) / count**0.9,
        sum(map(eq, words, words[1:])) / count,
        len(set(lines)) / len(lines),
        float(np.log1p(count / len(lines))),
        n[_SIGN] / count,
        float(np.log1p(max(lengths))),
        sum(map(bytes.isupper, words)) / count,
    ]


@dataclass(frozen=True)
class Training:
    """``rows``: the bound of the labelled sample. Every other number is a setting of the boosting."""

    rows: int = 20_000
    bins: int = 48
    pair_bins: int = 8
    pairs: int = 6
    rounds: int = 60
    pair_rounds: int = 30
    rate: float = 0.15
    leaves: int = 4
    least_weight: float = 3.0
    #: Rows with crc32(id as text) mod ``folds`` equal to ``held_out`` are never learnt from.
    folds: int = 4
    held_out: int = 2
    accept: float = 0.7


@dataclass
class PairwiseGam:
    """Sum of ``tables`` over bins of one feature and ``pair_tables`` over bins of two, through a logistic curve."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            out += table[np.searchsorted(self.edges[j], x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right") for pair in self.pair_tables for j in pair}
        for (i, j), table in self.pair_tables.items():
            out += table[coarse[i], coarse[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Newton steps of a shallow tree over the ordered bins: the best cut of the best leaf, leaf by leaf."""
    parts = [(0, len(g))]
    gain_of = lambda a, b: a * a / (b + 1.0)
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for k, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gt, ht = g[lo:hi].sum(), h[lo:hi].sum()
            gain = np.where((hl >= least) & (ht - hl >= least), gain_of(gl, hl) + gain_of(gt - gl, ht - hl) - gain_of(gt, ht), 0)
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (gain[at], k, lo + at + 1)
        if best[1] is None:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = g[lo:hi].sum() / (h[lo:hi].sum() + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """One cut on each axis: the best four quadrants of the grid."""
    best, at = 0.0, (0, 0)
    G, H = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    for a, b in np.ndindex(g.shape[0] - 1, g.shape[1] - 1):
        q = [(G[a, b], H[a, b]), (G[a, -1] - G[a, b], H[a, -1] - H[a, b]), (G[-1, b] - G[a, b], H[-1, b] - H[a, b])]
        q.append((G[-1, -1] - sum(x for x, _ in q), H[-1, -1] - sum(y for _, y in q)))
        gain = sum(x * x / (y + 1.0) for x, y in q if y >= least)
        if gain > best:
            best, at = gain, (a, b)
    out = np.zeros_like(g)
    for rows in (slice(0, at[0] + 1), slice(at[0] + 1, None)):
        for columns in (slice(0, at[1] + 1), slice(at[1] + 1, None)):
            if h[rows, columns].sum() >= least:
                out[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + 1.0)
    return out, best


def fit(x: np.ndarray, y: np.ndarray, how: Training) -> PairwiseGam:
    """``x``: rows by features, ``y``: 0 or 1. Without rows every score is 1, so that nothing is rejected unlearnt."""
    if not len(y):
        return PairwiseGam(30.0)
    p = (y.sum() + 1) / (len(y) + 2)
    edges = [_cut_points(x[:, j], how.bins) for j in range(x.shape[1])]
    model = PairwiseGam(float(np.log(p / (1 - p))), edges, [np.zeros(len(e) + 1) for e in edges], [_cut_points(x[:, j], how.pair_bins) for j in range(x.shape[1])])
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    raw = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-raw))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(how.rounds):
        for j, b in enumerate(bins):
            if len(edges[j]) == 0:
                continue
            g, h = slopes()
            step = how.rate * _tree(np.bincount(b, g, len(edges[j]) + 1), np.bincount(b, h, len(edges[j]) + 1), how.leaves, how.least_weight)
            model.tables[j] += step
            raw += step[b]

    def grid(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
        at, (g, h) = coarse[i] * shape[1] + coarse[j], slopes()
        return tuple(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    usable = [j for j, e in enumerate(model.pair_edges) if len(e)]
    ranked = sorted(combinations(usable, 2), key=lambda pair: -_pair_tree(*grid(*pair), how.least_weight)[1])
    for pair in ranked[: how.pairs]:
        model.pair_tables[pair] = np.zeros([len(model.pair_edges[j]) + 1 for j in pair])
    for _ in range(how.pair_rounds):
        for (i, j), table in model.pair_tables.items():
            step = how.rate * _pair_tree(*grid(i, j), how.least_weight)[0]
            table += step
            raw += step[coarse[i], coarse[j]]
    return model


def held_out(doc_id: Column, how: Training) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % how.folds == how.held_out, F.lit(False))


def _binary_text() -> Column:
    return F.col("text").cast("string").cast("binary").alias("text")


def learn(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> PairwiseGam:
    """Fits the model to at most ``how.rows`` labelled documents, those with the smallest hashes of their ids.

    Labels are 0 or 1; null labels, held-out rows and null ids are not used. A
    document that is labelled twice counts twice.
    """
    how = how or Training()
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), how))
    sample = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "quality").limit(how.rows)
    rows = docs.select("doc_id", _binary_text()).join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _byte_classes()
        for batch in batches:
            x = [features_of(t.as_py(), kinds) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("quality"), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    found = map_arrow(rows.withColumn("doc_id", F.col("doc_id").cast("string")), measure, "doc_id string, quality int, x array<double>").toPandas()
    found["key"] = found.x.map(tuple)
    found = found.sort_values(["doc_id", "quality", "key"])  # the same sum in the same order on every run
    x = np.array(found.x.tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, found.quality.to_numpy(float), how)


def score_quality(docs: DataFrame, model: PairwiseGam, how: Training | None = None) -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1, of the whole text alone) and ``predicted`` (1 from ``how.accept`` on).

    All columns are kept; columns that are named like the new ones are
    replaced. Null texts are scored as empty ones.
    """
    how = how or Training()
    docs = docs.drop("score", "predicted")
    others = [c for c in docs.columns]
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _byte_classes()
        for batch in batches:
            x = np.array([features_of((t.as_py() or "").encode(), kinds) for t in batch.column("text")], float).reshape(-1, len(FEATURES))
            s = model.score(x)
            arrays = [batch.column(c) for c in others] + [pa.array(s), pa.array((s >= how.accept).astype(np.int32))]
            yield pa.record_batch(arrays, names=[*others, "score", "predicted"])

    return map_arrow(docs, score, schema)


def quality_report(docs: DataFrame, labels: DataFrame, how: Training | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    how = how or Training()
    model = learn(docs, labels, how)
    return score_quality(docs.select("doc_id", "text"), model, how).select("doc_id", held_out(F.col("doc_id"), how).alias("held_out"), "score", "predicted")
