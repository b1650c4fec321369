"""Bidirectional gated recurrent network with attention pooling over windows of words, in numpy.

A word enters as a hashed embedding of itself and the mean of hashed embeddings of its byte trigrams. Two
gated recurrent layers read a window in either direction; attention pools their states to one logit.
"""

from __future__ import annotations

import numpy as np

from nightledger.llm.words import ALNUM, Words

WINDOW, STRIDE = 48, 24  # neighbours overlap by half a window
WORD_BITS, GRAM_BITS, WIDTH, HIDDEN, ATTEND = 15, 15, 8, 8, 8
Params = dict[str, np.ndarray]


class Encoded:
    """Words of several texts as table rows, and the windows that cover them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, ALNUM, lower=True)
        self.counts, self.first = words.counts, words.first
        self.word = (words.hashes() >> np.uint64(64 - WORD_BITS)).astype(np.uint16)
        length = words.end - words.start
        self.gram_first = np.concatenate([[0], np.cumsum(length)])
        at = np.repeat(words.start - self.gram_first[:-1], length) + np.arange(self.gram_first[-1])
        here = words.data[at].astype(np.uint32)
        before, after = np.append(np.uint32(0), here[:-1]), np.append(here[1:], np.uint32(0))
        before[self.gram_first[:-1]] = 0
        after[self.gram_first[1:] - 1] = 0
        code = ((before << np.uint32(16)) | (here << np.uint32(8)) | after) * np.uint32(2654435761)
        self.gram = (code >> np.uint32(32 - GRAM_BITS)).astype(np.uint16)
        # windows: every text has one at least; the last one ends with the text
        extra = np.maximum(0, -(-(self.counts - WINDOW) // STRIDE))
        self.text = np.repeat(np.arange(len(self.counts)), extra + 1)
        place = np.arange(len(self.text)) - np.repeat(np.cumsum(extra + 1) - (extra + 1), extra + 1)
        start = np.minimum(place * STRIDE, np.maximum(0, self.counts[self.text] - WINDOW))
        self.start = self.first[self.text] + start
        self.size = np.minimum(WINDOW, self.counts[self.text])

    def inputs(self, p: Params, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Input vectors of words ``lo`` to ``hi``."""
        hi = len(self.word) if hi is None else hi
        out = np.empty((hi - lo, 2 * WIDTH), np.float32)
        out[:, :WIDTH] = p["word"][self.word[lo:hi]]
        if len(out):
            edges = self.gram_first[lo : hi + 1]
            total = np.add.reduceat(p["gram"][self.gram[edges[0] : edges[-1]]], edges[:-1] - edges[0], axis=0)
            out[:, WIDTH:] = total / np.sqrt(np.diff(edges))[:, None].astype(np.float32)
        return out

    @classmethod
    def joined(cls, parts: list[Encoded]) -> Encoded:
        """The texts of several parts as one."""
        out = object.__new__(cls)
        words = np.cumsum([0] + [len(x.word) for x in parts])
        texts = np.cumsum([0] + [len(x.counts) for x in parts])
        grams = np.cumsum([0] + [len(x.gram) for x in parts])
        for name, shift in (("counts", None), ("word", None), ("gram", None), ("size", None), ("text", texts), ("start", words)):
            out.__dict__[name] = np.concatenate([getattr(x, name) + (shift[i] if shift is not None else 0) for i, x in enumerate(parts)])
        out.word, out.gram = out.word.astype(np.uint16), out.gram.astype(np.uint16)
        out.gram_first = np.concatenate([x.gram_first[:-1] + grams[i] for i, x in enumerate(parts)] + [grams[-1:]])
        return out


def initial(seed: int = 5) -> Params:
    rng = np.random.Generator(np.random.PCG64(seed))

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    p = {"word": normal(1 << WORD_BITS, WIDTH, scale=0.1), "gram": normal(1 << GRAM_BITS, WIDTH, scale=0.1)}
    for way in "fb":
        p["x" + way] = normal(2 * WIDTH, 3 * HIDDEN, scale=0.3)
        p["h" + way] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
        p["c" + way] = np.zeros(3 * HIDDEN, np.float32)
    p["a"], p["ab"] = normal(2 * HIDDEN, ATTEND, scale=0.3), np.zeros(ATTEND, np.float32)
    p["v"], p["o"] = normal(ATTEND, scale=0.3), normal(2 * HIDDEN, scale=0.3)
    p["ob"] = np.zeros(1, np.float32)
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _read(p: Params, way: str, steps: np.ndarray, on: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of one direction; ``steps`` are the projected inputs (time, window, 3 * HIDDEN)."""
    h = np.zeros((steps.shape[1], HIDDEN), np.float32)
    out = np.empty((*steps.shape[:2], HIDDEN), np.float32)
    for t in range(len(steps)) if way == "f" else range(len(steps) - 1, -1, -1):
        inner = h @ p["h" + way]
        gates = _sigmoid(steps[t, :, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(steps[t, :, 2 * HIDDEN :] + r * inner[:, 2 * HIDDEN :])
        z = np.where(on[t][:, None], z, np.float32(1))
        if keep is not None:
            keep.append((t, h, inner, r, z, new))
        h = z * h + (1 - z) * new
        out[t] = h
    return out


def forward(p: Params, inputs: np.ndarray, start: np.ndarray, size: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logit of each window of ``size`` words from ``start``; a window without words has the bias alone."""
    length = int(size.max()) if len(size) else 0
    if not length:
        return np.full(len(size), p["ob"][0])
    at = start[None, :] + np.arange(length)[:, None]
    on = np.arange(length)[:, None] < size[None, :]
    at = np.where(on, at, 0)
    states, tapes = [], {}
    for way in "fb":
        steps = (inputs @ p["x" + way] + p["c" + way])[at]
        tapes[way] = [] if keep is not None else None
        states.append(_read(p, way, steps, on, tapes[way]))
    both = np.concatenate(states, 2)
    hidden = np.tanh(both @ p["a"] + p["ab"])
    weight = np.where(on, hidden @ p["v"], np.float32(-30))
    weight = np.exp(weight - weight.max(0)) * on
    weight /= np.maximum(weight.sum(0), 1e-9)
    pooled = (weight[:, :, None] * both).sum(0)
    if keep is not None:
        keep.update(at=at, on=on, both=both, hidden=hidden, weight=weight, pooled=pooled, tapes=tapes)
    return pooled @ p["o"] + p["ob"][0]


def backward(p: Params, inputs: np.ndarray, kept: dict, slope: np.ndarray) -> tuple[Params, np.ndarray]:
    """Gradients of all but the tables, and of ``inputs``, for the slope of the loss by each logit."""
    g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "gram")}
    both, weight, hidden, on = kept["both"], kept["weight"], kept["hidden"], kept["on"]
    g["o"], g["ob"] = kept["pooled"].T @ slope, slope.sum(keepdims=True)
    d_pooled = slope[:, None] * p["o"]
    d_both = weight[:, :, None] * d_pooled
    d_weight = (both * d_pooled).sum(2)
    d_score = weight * (d_weight - (weight * d_weight).sum(0))
    g["v"] = np.einsum("tba,tb->a", hidden, d_score)
    d_hidden = d_score[:, :, None] * p["v"] * (1 - hidden**2)
    g["a"] = np.einsum("tbs,tba->sa", both, d_hidden)
    g["ab"] = d_hidden.sum((0, 1))
    d_both = d_both + d_hidden @ p["a"].T
    d_inputs = np.zeros_like(inputs)
    for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
        d_steps = np.zeros((*on.shape, 3 * HIDDEN), np.float32)
        d_h = np.zeros((on.shape[1], HIDDEN), np.float32)
        for t, h, inner, r, z, new in reversed(kept["tapes"][way]):
            d_h = d_h + d_both[t][:, part]
            d_new = d_h * (1 - z) * (1 - new**2)
            d_z = d_h * (h - new) * z * (1 - z)
            d_r = d_new * inner[:, 2 * HIDDEN :] * r * (1 - r)
            d_steps[t] = np.concatenate([d_r, d_z, d_new], 1)
            d_inner = np.concatenate([d_r, d_z, d_new * r], 1)
            g["h" + way] += h.T @ d_inner
            d_h = d_h * z + d_inner @ p["h" + way].T
        d_steps *= on[:, :, None]
        flat, rows = d_steps[on], kept["at"][on]
        g["x" + way] = inputs[rows].T @ flat
        g["c" + way] = flat.sum(0)
        np.add.at(d_inputs, rows, flat @ p["x" + way].T)
    return g, d_inputs
