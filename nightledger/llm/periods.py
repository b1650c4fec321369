"""Runs of repeated words: stretches that repeat with a period, found while a text is read word by word.

The suffix automaton of the words is built first. Its suffix links form a tree in which the prefixes of the text
are nodes; the path of a prefix to the root holds all its suffixes. The text is then replayed: each appended word
accesses the path of its prefix in a link-cut tree, whose preferred paths are the segments of one last occurrence,
and recolours it with the new end. A segment met on the way, of length L and last end j, says that the last L words
before the new end i also end at j: the stretch of L + (i - j) words has the period i - j. It is long enough for a
run if L is at least (times - 1) periods; the next appended words meet the same run again until it ends. L is
the longest common suffix of the two ends, so the stretch cannot be extended to the left, and a shorter period
would have been a later last occurrence, so the period is the smallest.

A window of k words that occurs once in its text is in no run, with k the least length minus the longest period
that length allows. Only the stretches covered by windows that occur again in the same text are read; a run and all its
windows lie within one of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from nightledger.llm.frames import Carried
from nightledger.llm.words import SPACED, Words, mix, slabs, window_hashes, window_starts

LEAST, TIMES = 24, 3
RUN = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("period", pa.int32())])
RUN_TYPE = StructType([StructField(n, IntegerType()) for n in ("start", "length", "period")])


def automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and length of each state of the suffix automaton, and the state of each prefix."""
    link, size, steps = [-1], [0], [{}]
    last, ends = 0, []
    for word in words:
        new = len(size)
        size.append(size[last] + 1)
        link.append(0)
        steps.append({})
        ends.append(new)
        at = last
        while at >= 0 and word not in steps[at]:
            steps[at][word] = new
            at = link[at]
        if at >= 0:
            old = steps[at][word]
            if size[old] == size[at] + 1:
                link[new] = old
            else:
                clone = len(size)
                size.append(size[at] + 1)
                link.append(link[old])
                steps.append(steps[old].copy())
                link[old] = link[new] = clone
                while at >= 0 and steps[at].get(word) == old:
                    steps[at][word] = clone
                    at = link[at]
        last = new
    return link, size, ends


class LastEnds:
    """The link tree as a link-cut tree: splay trees over path segments of one last end.

    The end is kept at the root of each splay tree. ``up`` of such a root is the node above the segment.
    """

    def __init__(self, link: list[int]):
        self.up = list(link)
        self.left = [-1] * len(link)
        self.right = [-1] * len(link)
        self.end = [-1] * len(link)

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        if y < 0 or (left[y] != x and right[y] != x):
            return
        while True:
            y = up[x]
            if y < 0 or (left[y] != x and right[y] != x):
                break
            z = up[y]
            inner = z >= 0 and (left[z] == y or right[z] == y)  # z is in the same tree
            root_end = self.end[z if inner else y]
            if inner:  # the grandparent turns first if both lean the same way
                self._turn(y if (left[z] == y) == (left[y] == x) else x)
            self._turn(x)
        self.end[x] = root_end

    def _turn(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if left[y] == x:
            child = left[y] = right[x]
            right[x] = y
        else:
            child = right[y] = left[x]
            left[x] = y
        if child >= 0:
            up[child] = y
        up[x], up[y] = z, x
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def access(self, node: int, end: int) -> Iterator[tuple[int, int]]:
        """(last end, deepest node) of each segment on the path from ``node`` to the root, which takes the new end."""
        below, at = -1, node
        while at >= 0:
            self._splay(at)
            seen, deeper = self.end[at], self.right[at]
            if deeper >= 0:  # what lies deeper in the segment is cut off with its own last end
                self.end[deeper] = seen
            if seen >= 0:
                yield seen, at
            self.right[at] = below
            below, at = at, self.up[at]
        self.end[below] = end
        self._splay(node)


def runs_of(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``least`` words and ``times`` periods, by start and period."""
    link, size, ends = automaton(words)
    tree, last = LastEnds(link), {}
    for end, node in enumerate(ends):
        for before, deepest in tree.access(node, end):
            period, length = end - before, size[deepest]
            if length >= (times - 1) * period:
                last[before - length + 1, period] = end
    found = ((start, end - start + 1, period) for (start, period), end in last.items())
    return sorted((s, n, p) for s, n, p in found if n >= least)


def _regions(words: Words, size: int) -> list[tuple[int, int]]:
    """Word ranges covered by windows of ``size`` words that start more than once in their text."""
    starts = window_starts(words, size)
    if len(starts) < 2:
        return []
    text = words.text_of()[starts]
    key = mix(window_hashes(words.hashes(), starts, size) + (text.astype(np.uint64) << np.uint64(32)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(starts), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    first = starts[twice]
    if not len(first):
        return []
    owner = text[twice]
    apart = np.flatnonzero((first[1:] > first[:-1] + size) | (owner[1:] != owner[:-1]))
    lo = first[np.concatenate([[0], apart + 1])]
    hi = first[np.concatenate([apart, [len(first) - 1]])] + size
    return list(zip(lo.tolist(), hi.tolist(), strict=True))


def slab_runs(words: Words, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of the runs of all texts."""
    out = []
    for lo, hi in _regions(words, least - least // times):
        text = int(np.searchsorted(words.first, lo, "right")) - 1
        shift = lo - int(words.first[text])
        ids: dict[bytes, int] = {}
        named = [ids.setdefault(words.word(i), i) for i in range(lo, hi)]
        out += [(text, start + shift, n, p) for start, n, p in runs_of(named, least, times)]
    return sorted(out)


def _kept(words: Words, found: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Words that no run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for text, start, length, period in found:
        at = int(words.first[text]) + start
        change[at + period] += 1
        change[at + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _joined(words: Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    chosen = np.flatnonzero(keep)
    start, end = words.start[chosen], words.end[chosen]
    text = words.text_of()[chosen]
    inside = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    out = np.where(inside, words.data, 0x20).astype(np.uint8)
    between = end[:-1][text[1:] == text[:-1]]  # a separator follows every word that is not the last of its text
    mask = inside.copy()
    mask[between] = True
    total = np.concatenate([[0], np.cumsum(mask)])
    at = total[words.offsets].astype(np.int32)
    return pa.StringArray.from_buffers(len(words.counts), pa.py_buffer(at.tobytes()), pa.py_buffer(out[mask].tobytes()))


def _lists(found: list[tuple[int, int, int, int]], texts: int) -> pa.Array:
    rows = np.array(found, np.int64).reshape(-1, 4)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows[:, 0], minlength=texts))]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(rows[:, i], pa.int32()) for i in (1, 2, 3)], fields=list(RUN))
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The columns of ``docs`` with n_words, runs and collapsed; columns of these names are replaced.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` holds start (word number from 0), length and smallest period of every
    longest stretch of at least ``least`` words and ``times`` (two or more) periods, by start and period. ``collapsed`` is
    the words joined by one blank without those that a run contains after its first period. Null and empty texts, and
    texts without words, have no runs and an empty ``collapsed``. Rows are independent, so repeated rows and
    null ids are judged each; an empty table gives no rows. A task holds one slab of texts or one longer text, and the
    automaton of one repeated stretch, some 500 bytes a word.
    """
    if times < 2 or least < times:
        raise ValueError("a run has at least two periods, and as many words as periods")
    carried = Carried(docs, "text")
    added = [StructField("n_words", LongType()), StructField("runs", ArrayType(RUN_TYPE)), StructField("collapsed", StringType())]
    schema = carried.schema(*added)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text")):
                words = Words(data, offsets, SPACED)
                found = slab_runs(words, least, times)
                new = [pa.array(words.counts, pa.int64()), _lists(found, hi - lo), _joined(words, _kept(words, found))]
                old = [batch.column(c).slice(lo, hi - lo) for c in ("row", "text")]
                yield pa.RecordBatch.from_arrays([*old, *new], names=schema.names)

    out = carried.work.mapInArrow(scan, schema)
    return carried.back(out, {f.name: F.col(f.name) for f in added})
