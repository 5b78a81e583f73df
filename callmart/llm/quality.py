"""Quality classifier: gradient-boosted trees over histograms of document statistics.

Statistics of a whole text are counted from its bytes and words. Their values are binned once; a tree is then grown
from sums of gradients over bins. Trees are of equal depth and kept as flat arrays, level by level, so that a
batch of documents walks down all trees in a few steps of whole-array arithmetic. The model is fitted on the driver
on the statistics, a short row of numbers, of a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.llm.common import batches_of, sigmoid, texts

#: Most labelled texts that a model is fitted on. Only their statistics reach the driver.
SAMPLE_ROWS = 20_000
TREES = 120
DEPTH = 4
BINS = 64

_MARKS = b"!?.,;:|#$%&*<>\"'-_=/@()[]{}"
STATISTICS = [
    "log_bytes", "log_words", "log_lines", "word_length", "longest_word", "line_words", "longest_line",
    "distinct_words", "commonest_word", "repeated_lines", "lower", "upper", "digits", "spaces", "not_ascii",
    "words_in_capitals", "words_with_marks", "short_words", "entropy", "ends_in_stop",
    *[f"mark_{b}" for b in _MARKS],
]


def statistics_of(text: bytes) -> list[float]:
    """The numbers named in STATISTICS; all 0 for an empty text."""
    size = len(text)
    if not size:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    each = Counter(words)
    long_lines = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1, np.int64)
    share = count[count > 0] / size
    ends = {33, 44, 46, 58, 59, 63}
    return [
        np.log1p(size),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        float(lengths.mean()),
        float(np.log1p(lengths.max())),
        n / max(1, len(lines)),
        float(np.log1p(long_lines.max())),
        len(each) / n,
        (each.most_common(1)[0][1] if each else 0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(count[97:123].sum()) / size,
        float(count[65:91].sum()) / size,
        float(count[48:58].sum()) / size,
        float(count[32] + count[9:14].sum()) / size,
        float(count[128:].sum()) / size,
        sum(k for w, k in each.items() if w.isupper()) / n,
        sum(k for w, k in each.items() if w[-1] in b"#$%&*|<>!") / n,
        float((lengths <= 3).mean()),
        float(-(share * np.log2(share)).sum()),
        sum(x.rstrip()[-1] in ends for x in lines) / max(1, len(lines)),
        *(float(count[b]) / size for b in _MARKS),
    ]


@dataclass(frozen=True)
class Trees:
    """Flat trees: node k of a level has children 2k and 2k + 1 on the next; ``value`` is by leaf."""

    feature: np.ndarray  # trees x (2 ** depth - 1)
    limit: np.ndarray
    value: np.ndarray  # trees x 2 ** depth
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        trees, nodes = self.feature.shape
        depth, at = int(np.log2(nodes + 1)), np.zeros((len(x), trees), np.int64)
        rows, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for level in range(depth):
            node = at + (1 << level) - 1
            at = 2 * at + (x[rows, self.feature[tree, node]] > self.limit[tree, node])
        return sigmoid(self.base + self.value[tree, at].sum(axis=1))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = TREES,
    depth: int = DEPTH,
    bins: int = BINS,
    rate: float = 0.12,
    shrink: float = 2.0,
    least: float = 3.0,
) -> Trees:
    """Newton boosting of the log loss. Without rows, or with one label only, no tree is grown."""
    width = (1 << depth) - 1
    feature, limit = np.zeros((trees, width), np.int64), np.full((trees, width), np.inf)
    value = np.zeros((trees, width + 1))
    if not len(y):
        return Trees(feature, limit, value, 0.0)
    mean = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    base = float(np.log(mean / (1 - mean)))
    if y.min() == y.max():
        return Trees(feature, limit, value, base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
    columns = x.shape[1]
    z = np.full(len(y), base)
    for t in range(trees):
        p = sigmoid(z)
        slope, bend = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            best = np.full(nodes, 1e-9)
            for f in range(columns):
                if not len(edges[f]):
                    continue
                cell = at * bins + binned[:, f]
                g = np.bincount(cell, slope, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                h = np.bincount(cell, bend, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + shrink) + (g_all - g) ** 2 / (h_all - h + shrink) - g_all**2 / (h_all + shrink)
                gain[(h < least) | (h_all - h < least)] = -1
                gain = gain[:, : len(edges[f])]
                cut = gain.argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(nodes), cut] > best)
                best[better] = gain[better, cut[better]]
                feature[t, first + better] = f
                limit[t, first + better] = edges[f][cut[better]]
            node = first + at
            at = 2 * at + (x[np.arange(len(y)), feature[t, node]] > limit[t, node])
        g, h = np.bincount(at, slope, width + 1), np.bincount(at, bend, width + 1)
        value[t] = -rate * g / (h + shrink)
        z += value[t, at]
    return Trees(feature, limit, value, base)


def statistics(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but text (binary), and ``x``, the statistics of the text."""
    kept = [c for c in rows.columns if c != "text"]
    ordered = rows.select("text", *kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            x = pa.array([statistics_of(t.as_py()) for t in batch.column(0)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], x], [*kept, "x"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema if f.name != "text")
    return ordered.mapInArrow(run, f"{schema}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, training: Column, rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled documents for which ``training`` holds, in the order of a hash of their ids."""
    order = F.xxhash64("doc_id")
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & training)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("quality").cast("double").alias("label"))
        .orderBy(order, "doc_id")
        .limit(rows)
    )
    # At most ``rows`` rows of two numbers.
    sample = statistics(texts(docs).join(F.broadcast(chosen), "doc_id")).orderBy("doc_id", "x").limit(2 * rows)
    found = sample.select("x", "label").collect()
    return fit(np.array([r["x"] for r in found]).reshape(-1, len(STATISTICS)), np.array([r["label"] for r in found]))


def score(docs: DataFrame, model: Trees, threshold: float = 0.7) -> DataFrame:
    """doc_id, score and predicted of every whole text.

    An empty or missing text has statistics of 0 and is scored by the model like any other. Rows without doc_id, repeated rows and
    texts of any length are scored like others; columns other than doc_id and text are not read.
    """
    # Of fixed size: trees times nodes.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches):
            scores = []
            for a in range(0, batch.num_rows, 1024):
                x = np.array([statistics_of(t.as_py()) for t in batch.column(1).slice(a, 1024)])
                scores.append(shared.value.score(x))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], ["doc_id", "score"])

    scored = texts(docs).mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
