"""Toxicity of whole texts: the largest score over all overlapping windows of a document.

The network of ``gru`` learns on the driver from a bounded labelled sample. A toxic document teaches through the window
that looks most toxic so far, any other through its most suspicious window and a random one. The first dimension
of either table starts from smoothed log odds of the sample, which gives the first choice of windows. The
parameters (about 2 MB, whatever the data) are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from nightledger.llm import gru
from nightledger.llm.folds import held_out, sample
from nightledger.llm.frames import Carried
from nightledger.llm.words import slabs

SAMPLE_ROWS = 1500  # of each class
SAMPLE_BYTES = 16 << 10
SLAB = 512 << 10
LEARN_SLAB, LEARN_WINDOWS = 64 << 10, 512  # texts and windows that learning handles at once, on the driver
EPOCHS, STEPS, BATCH, RATE = 8, 200, 128, 0.01  # epochs grow on few rows, up to STEPS batches


def _odds(parts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int) -> np.ndarray:
    """Smoothed log odds of the label for each table row, from (rows, texts) that contain them."""
    toxic, rest = np.zeros(size), np.zeros(size)
    for ids, texts in parts:
        pair = np.unique(texts.astype(np.int64) * size + ids)
        text, row = pair // size, pair % size
        toxic += np.bincount(row, labels[text], size)
        rest += np.bincount(row, 1 - labels[text], size)
    n1, n0 = labels.sum(), (1 - labels).sum()
    odds = np.log((toxic + 0.5) / (n1 + 1)) - np.log((rest + 0.5) / (n0 + 1))
    return np.where(toxic + rest > 0, np.clip(odds, -3, 6), 0).astype(np.float32)


def train(texts: list[str], labels: np.ndarray, seed: int = 5) -> gru.Params:
    """Parameters learnt from texts and 0/1 labels; with one class only, the bias says which."""
    p = gru.initial(seed)
    if not len(labels) or labels.min() == labels.max():
        p["o"][:] = 0
        p["ob"][:] = 0 if not len(labels) else 4 * labels[0] - 2
        return p
    parts, word_rows, gram_rows = [], [], []
    for lo, _, data, offsets in slabs(pa.array(texts, pa.large_string()), LEARN_SLAB):
        part = gru.Encoded(data, offsets)
        owner = np.repeat(np.arange(lo, lo + len(part.counts)), part.counts)
        parts.append(part)
        word_rows.append((part.word, owner))
        gram_rows.append((part.gram, owner, np.diff(part.gram_first)))
    p["word"][:, 0] = 0.5 * _odds(word_rows, labels, 1 << gru.WORD_BITS)
    p["gram"][:, 0] = 0.2 * _odds(((g, np.repeat(o, n)) for g, o, n in gram_rows), labels, 1 << gru.GRAM_BITS)
    rng = np.random.Generator(np.random.PCG64(seed))
    guess = []
    for part in parts:
        total = np.maximum(part.inputs(p)[:, [0, gru.WIDTH]].sum(1), 0) ** 2
        total = np.concatenate([[0], np.cumsum(total)])
        guess.append(total[part.start + part.size] - total[part.start])
    score, coded = np.concatenate(guess), gru.Encoded.joined(parts)
    del parts, word_rows, gram_rows
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    step, toxic = 0, labels[coded.text] > 0
    first = np.searchsorted(coded.text, np.arange(len(labels)))
    epochs = int(np.clip(-(-STEPS * BATCH // (len(labels) + (labels == 0).sum())), EPOCHS, 5 * EPOCHS))
    for epoch in range(epochs):
        if epoch:
            score = window_logits(p, coded, LEARN_WINDOWS)
        order = np.lexsort((-score, coded.text))
        top = order[first]
        last = np.append(first[1:], len(coded.text))
        other = (first + rng.random(len(first)) * (last - first)).astype(np.int64)
        chosen = np.concatenate([top, other[labels == 0]])
        rng.shuffle(chosen)
        rate = RATE / (1 + 8 * epoch / epochs)
        for lo in range(0, len(chosen), BATCH):
            own = chosen[lo : lo + BATCH]
            step += 1
            _learn(p, m, s, step, coded, own, toxic[own].astype(np.float32), rate)
    return p


def _learn(p, m, s, step, coded, own, target, rate) -> None:
    """One step of the batch ``own`` of windows."""
    at = np.concatenate([np.arange(a, a + n) for a, n in zip(coded.start[own], coded.size[own], strict=True)])
    grams = [np.arange(coded.gram_first[a], coded.gram_first[a + n]) for a, n in zip(coded.start[own], coded.size[own], strict=True)]
    grams = np.concatenate(grams) if grams else np.empty(0, np.int64)
    if not len(at):
        return
    part = object.__new__(gru.Encoded)
    part.word, part.gram = coded.word[at], coded.gram[grams]
    length = np.diff(coded.gram_first)[at]
    part.gram_first = np.concatenate([[0], np.cumsum(length)])
    start = np.concatenate([[0], np.cumsum(coded.size[own])[:-1]])
    inputs, kept = part.inputs(p), {}
    logit = gru.forward(p, inputs, start, coded.size[own], kept)
    slope = (1 / (1 + np.exp(-logit)) - target) / len(own)
    grad, d_inputs = gru.backward(p, inputs, kept, slope.astype(np.float32))
    grad["word"], grad["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
    np.add.at(grad["word"], part.word, d_inputs[:, : gru.WIDTH])
    d_gram = d_inputs[:, gru.WIDTH :] / np.sqrt(length)[:, None]
    np.add.at(grad["gram"], part.gram, np.repeat(d_gram, length, axis=0).astype(np.float32))
    for k, g in grad.items():
        m[k] += 0.1 * (g - m[k])
        s[k] += 0.01 * (g * g - s[k])
        p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)


def window_logits(p: gru.Params, coded: gru.Encoded, block: int = 4096) -> np.ndarray:
    """Logit of every window, a block of neighbouring windows at a time."""
    parts = []
    for lo in range(0, len(coded.start), block):
        start, size = coded.start[lo : lo + block], coded.size[lo : lo + block]
        first = int(start.min())
        inputs = coded.inputs(p, first, int((start + size).max()))
        parts.append(gru.forward(p, inputs, start - first, size))
    return np.concatenate(parts) if parts else np.empty(0)


def scores(p: gru.Params, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Score of each text: its most toxic window."""
    coded = gru.Encoded(data, offsets)
    first = np.searchsorted(coded.text, np.arange(len(coded.counts)))
    top = np.maximum.reduceat(window_logits(p, coded), first) if len(first) else np.empty(0)
    return 1 / (1 + np.exp(-top.astype(np.float64)))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> gru.Params:
    """Parameters from at most ``rows`` learnable rows of each class."""
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    some = sample(docs, labels, "toxic", held_out(5, 0), rows, SAMPLE_BYTES)
    got = sorted(some.select("doc_id", "text", "label").collect(), key=lambda r: (r.doc_id, r.text))
    return train([r.text for r in got], np.array([r.label for r in got], np.float64))


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The columns of ``docs`` with held_out, score and predicted; columns of these names are replaced.

    Only the text is an input of the score. Null and empty texts, and texts without words, are one empty window. A null id
    is not held out. Repeated rows are scored each. Without labels every score is one half.
    """
    carried = Carried(docs, "doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(fit(carried.work, labels, rows))
    schema = carried.schema(StructField("score", DoubleType()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text"), SLAB):
                part = batch.slice(lo, hi - lo).columns
                yield pa.RecordBatch.from_arrays([*part, pa.array(scores(shared.value, data, offsets))], names=schema.names)

    scored = carried.work.mapInArrow(score, schema)
    predicted = (F.col("score") >= 0.5).cast("int")
    return carried.back(scored, {"held_out": held_out(5, 0), "score": F.col("score"), "predicted": predicted})


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents predicted toxic, with its columns, whatever they are called."""
    carried = Carried(docs, "doc_id", "text")
    return carried.back(toxicity_scores(carried.work, labels).where("predicted = 0"))
