"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are made in tasks from the whole text. The trees are fitted with numpy on
at most ``TRAIN_ROWS`` labelled rows, flattened into arrays (feature, threshold, left,
value) and applied to whole batches: all rows step down a tree together.

Null and empty texts have statistics of zero and get a score like any other text. Very
long texts are read whole, in time in proportion to their length. Equal texts and repeated
rows score alike. Without labels of both kinds all texts score the share of label 1, one
half without any. An empty table gives no rows. Column names other than ``doc_id`` and
``text`` are never read; a column named as the score is replaced.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.llm.common import TRAIN_ROWS, fold, training_rows, whole, wider

STATISTICS = (
    "chars words mean_word long_words short_words distinct_words words_per_distinct repeated_neighbours distinct_lines line_chars short_lines "
    "ended_lines upper lower digits spaces stops marks symbols bars bangs wide_bytes distinct_bytes byte_entropy"
).split()

# Byte classes, as sums over a histogram of the UTF-8 bytes.
_CLASSES = [
    [*range(65, 91)],
    [*range(97, 123)],
    [*range(48, 58)],
    [9, 10, 11, 12, 13, 32],
    [*b".,;:?"],
    [*b"\"'()-"],
    [*b"#$%&*+/<=>@[\\]^_`{}~"],
    [*b"|"],
    [*b"!"],
    [*range(128, 256)],
]
_MASKS = np.zeros((256, len(_CLASSES)))
for _k, _bytes in enumerate(_CLASSES):
    _MASKS[_bytes, _k] = 1


def statistics(text: str) -> list[float]:
    """The document statistics of one text, in the order of STATISTICS."""
    if not text:
        return [0.0] * len(STATISTICS)
    words, lines = text.split(), text.split("\n")
    n, m = max(1, len(words)), len(lines)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    distinct = set(words)
    doubles = sum(map(operator.eq, words, words[1:]))
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    histogram = np.bincount(data, minlength=256)
    shares = histogram / len(data)
    there = shares[shares > 0]
    ended = sum(line.endswith((".", "!", "?")) for line in lines)
    return [
        float(np.log1p(len(text))),
        float(np.log1p(len(words))),
        float(lengths.mean()) if len(words) else 0.0,
        float((lengths > 12).mean()) if len(words) else 0.0,
        float((lengths < 4).mean()) if len(words) else 0.0,
        len(distinct) / n,
        float(np.log1p(n / max(1, len(distinct)))),
        doubles / n,
        len(set(lines)) / m,
        float(np.log1p(len(text) / m)),
        sum(len(line) < 30 for line in lines) / m,
        ended / m,
        *(shares @ _MASKS),
        len(there) / 256,
        float(-(there * np.log2(there)).sum()),
    ]


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``stats`` (array of double) of each whole text."""
    schema = wider(docs.select(*keep), "stats array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array([statistics(t or "") for t in batch["text"].to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch[k] for k in keep), stats], [*keep, "stats"])

    return docs.mapInArrow(run, schema)


@dataclass
class Trees:
    """All trees in flat arrays. Node i goes to left[i] if x[feature[i]] <= threshold[i], else to left[i] + 1; a leaf has left[i] == i."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray
    depth: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Vectorised traversal: depth steps for all rows of each tree."""
        rows, margin = np.arange(len(x)), np.full(len(x), self.start)
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                inner = self.left[node] != node
                node = np.where(inner, self.left[node] + (x[rows, self.feature[node]] > self.threshold[node]), node)
            margin += self.value[node]
        return 1 / (1 + np.exp(-margin))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, leaf: int = 5, ridge: float = 1.0) -> Trees:
    """Fit by Newton steps on binned columns; splits by gain of gradient and hessian histograms."""
    mean = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(mean / (1 - mean)))
    feature, threshold, left, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(0), threshold.append(0.0), left.append(len(left)), value.append(0.0)
        return len(left) - 1

    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
        margin = np.full(len(y), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, p * (1 - p)
            roots.append(root := node())
            level = [(root, np.arange(len(y)))]
            for d in range(depth + 1):
                below = []
                for at, rows in level:
                    gs, hs = g[rows].sum(), h[rows].sum()
                    best = (1e-6, -1, -1)
                    for j in range(x.shape[1]) if d < depth and len(rows) >= 2 * leaf else ():
                        b = binned[rows, j]
                        gl, hl, nl = (np.cumsum(np.bincount(b, w, bins))[:-1] for w in (g[rows], h[rows], None))
                        gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                        gain[(nl < leaf) | (len(rows) - nl < leaf)] = -1
                        k = int(gain.argmax())
                        if gain[k] > best[0]:
                            best = (float(gain[k]), j, k)
                    if best[1] < 0:
                        value[at] = float(rate * gs / (hs + ridge))
                        margin[rows] += value[at]
                        continue
                    _, j, k = best
                    feature[at], threshold[at], left[at] = j, float(edges[j][k]), len(left)
                    one, two = node(), node()
                    low = binned[rows, j] <= k
                    below += [(one, rows[low]), (two, rows[~low])]
                level = below
    return Trees(start, np.array(roots, np.int64), np.array(feature, np.int64), np.array(threshold), np.array(left, np.int64), np.array(value), depth)


def learn(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> Trees:
    """The trees for ``labels.quality`` of the training folds (remainder of crc32 by 3 is not 1); the driver gets ``limit`` short rows at most."""
    rows = with_statistics(training_rows(docs, labels, "quality", fold("doc_id", 3) != 1, limit), "label").collect()
    rows.sort()
    x = np.array([r["stats"] for r in rows], float).reshape(len(rows), len(STATISTICS))
    return boost(x, np.array([float(r["label"] > 0) for r in rows]))


def score(docs: DataFrame, trees: Trees, into: str = "score") -> DataFrame:
    """All columns of ``docs`` kept in place, with ``into`` (0 to 1) added; a column of that name is replaced."""
    kept = docs.drop(into)
    schema = wider(kept, f"`{into}` double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t or "") for t in batch["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(trees.probability(x))], [*batch.schema.names, into])

    return kept.mapInArrow(run, schema)


def scored_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    found = score(docs.select("doc_id", whole().alias("text")), learn(docs, labels))
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
