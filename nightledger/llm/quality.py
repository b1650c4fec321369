"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics of a bounded labelled sample come to the driver, where the trees are grown in numpy on binned values.
They are flattened into arrays, broadcast (a few hundred kB, whatever the data) and walked for all documents of a batch and
all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.folds import held_out, sample
from nightledger.llm.words import SPACED, Words, slabs, window_hashes, window_starts

SAMPLE_ROWS = 10_000  # of each class
SAMPLE_BYTES = 64 << 10
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 80, 4, 64, 0.15, 1.0, 5.0

_GROUPS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\r\v\f", "\n", ".", ",", "!?", "|"]
_GROUPS += ["#$%&*@^~=+_", "<>{}[]()/\\", ":;\"'`-"]
_GROUP_OF = np.zeros((256, len(_GROUPS) + 2))
for _i, _chars in enumerate(_GROUPS):
    _GROUP_OF[[ord(c) for c in _chars], _i] = 1
_GROUP_OF[0x80:, len(_GROUPS)] = 1
_GROUP_OF[_GROUP_OF.sum(1) == 0, len(_GROUPS) + 1] = 1


def _spread(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct values and of the commonest value in each segment."""
    values = values.copy()
    n = np.diff(first)
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        values[lo:hi].sort()
    new = np.ones(len(values) + 1, bool)
    new[1:-1] = values[1:] != values[:-1]
    new[first] = True
    head = np.flatnonzero(new)
    size = np.append(np.diff(head), 0)
    at = np.searchsorted(head, first)
    distinct, most = np.diff(at), np.zeros(len(n))
    full = np.flatnonzero(n)
    if len(full):
        most[full] = np.maximum.reduceat(size, at[:-1][full])
    return distinct / np.maximum(n, 1), most / np.maximum(n, 1)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of statistics for each text."""
    n_texts, size = len(offsets) - 1, np.diff(offsets)
    owner = np.repeat(np.arange(n_texts, dtype=np.int64), size)
    histogram = np.bincount(owner * 256 + data, minlength=n_texts * 256).reshape(n_texts, 256)
    share = histogram / np.maximum(size, 1)[:, None]
    columns = [np.log1p(size), *(share @ _GROUP_OF).T]
    columns.append(-(share * np.log(np.maximum(share, 1e-12))).sum(1))

    words = Words(data, offsets, SPACED)
    n = np.maximum(words.counts, 1)
    text, length, hashes = words.text_of(), words.end - words.start, words.hashes()

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(text, values, n_texts) / n

    average = mean(length)
    head, tail = (data[words.start], data[words.end - 1]) if len(words) else (data[:0], data[:0])
    big_head, big_tail = (head >= 65) & (head <= 90), (tail >= 65) & (tail <= 90)
    plain = ((tail | 32) >= 97) & ((tail | 32) <= 122) | (tail >= 128)
    same = np.zeros(len(words), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    columns += [np.log1p(words.counts), average, np.sqrt(np.maximum(mean(length.astype(float) ** 2) - average**2, 0))]
    columns += [mean(length == 1), mean(length > 20), mean(big_head), mean(big_head & big_tail & (length > 1))]
    columns += [mean(plain), mean((tail == 46) | (tail == 44)), mean(same)]
    columns += _spread(hashes, words.first)
    for k in (2, 5):
        starts = window_starts(words, k)
        columns += _spread(window_hashes(hashes, starts, k), np.searchsorted(starts, words.first))
    lines = Words(data, offsets, np.arange(256) != 10)
    columns += [words.counts / np.maximum(lines.counts, 1), *_spread(lines.hashes(), lines.first)]
    return np.stack(columns, 1).astype(np.float32)


@dataclass
class Trees:
    """Complete trees in arrays: node i of a tree has children 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        for lo in range(0, len(rows), 4096):
            part = rows[lo : lo + 4096]
            tree, node = np.arange(len(self.feature)), np.zeros((len(part), len(self.feature)), np.int64)
            for _ in range(DEPTH):
                right = part[np.arange(len(part))[:, None], self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            total[lo : lo + 4096] += self.leaf[tree, node - (2**DEPTH - 1)].sum(1)
        return 1 / (1 + np.exp(-total))


def grow(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boosted trees for 0/1 labels; with one class, or none, the score is constant."""
    inner, share = 2**DEPTH - 1, (labels.sum() + 1) / (len(labels) + 2)
    feature = np.zeros((TREES, inner), np.int64)
    threshold = np.full((TREES, inner), np.inf, np.float32)
    trees = Trees(float(np.log(share / (1 - share))), feature, threshold, np.zeros((TREES, 2**DEPTH)))
    if not len(labels) or labels.min() == labels.max():
        return trees
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in rows.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T, strict=True)], 1)
    n_features, total = rows.shape[1], np.full(len(rows), trees.base)
    cell = binned + np.arange(n_features) * BINS
    valid = np.zeros((n_features, BINS), bool)
    for f, e in enumerate(edges):
        valid[f, : len(e)] = True
    for t in range(TREES):
        p = 1 / (1 + np.exp(-total))
        slope, curve, node = p - labels, p * (1 - p), np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            base, width = 2**level - 1, 2**level
            at = (node - base)[:, None] * (n_features * BINS) + cell
            grid = [
                np.bincount(at.ravel(), np.repeat(w, n_features), width * n_features * BINS)
                .reshape(width, n_features, BINS)
                .cumsum(2)
                for w in (slope, curve)
            ]
            (left, left_c), (whole, whole_c) = grid, (g[:, :, -1:] for g in grid)
            right, right_c = whole - left, whole_c - left_c
            gain = left**2 / (left_c + RIDGE) + right**2 / (right_c + RIDGE) - whole**2 / (whole_c + RIDGE)
            gain[(left_c < LEAST) | (right_c < LEAST) | ~valid] = 0
            best = gain.reshape(width, -1).argmax(1)
            for k in np.flatnonzero(gain.reshape(width, -1).max(1) > 1e-9):
                f, b = divmod(int(best[k]), BINS)
                feature[t, base + k], threshold[t, base + k] = f, edges[f][b]
            go = rows[np.arange(len(rows)), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + go
        end = node - inner
        down, up = np.bincount(end, curve, 2**DEPTH), np.bincount(end, slope, 2**DEPTH)
        trees.leaf[t] = -RATE * up / (down + RIDGE)
        total += trees.leaf[t][end]
    return trees


def _with_statistics(texts: DataFrame) -> DataFrame:
    """label and the statistics of each text."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text")):
                values = [r.tobytes() for r in statistics(data, offsets)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo), pa.array(values, pa.binary())],
                    names=["doc_id", "label", "row"],
                )

    return texts.mapInArrow(measure, "doc_id long, label int, row binary")


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    """Trees from at most ``rows`` learnable rows of each class."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    some = sample(docs, labels, "quality", held_out(3, 1), rows, SAMPLE_BYTES)
    got = sorted(_with_statistics(some.select("doc_id", "label", "text")).collect())
    if not got:
        return grow(np.empty((0, 1), np.float32), np.empty(0))
    return grow(np.stack([np.frombuffer(r.row, np.float32) for r in got]), np.array([r.label for r in got], float))


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.

    Only the text is an input of the score. Null and empty texts have the statistics of an empty text. A null id is not
    held out. Repeated rows are scored each. Without labels every score is one half. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text")):
                ids = batch.column("doc_id").slice(lo, hi - lo)
                values = pa.array(shared.value.scores(statistics(data, offsets)))
                yield pa.RecordBatch.from_arrays([ids, values], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
