"""Ranked lexical search: exact inner products of sparse vectors through ball trees.

A document's vector holds, for each item term in it, a whole number that grows with the term's occurrences and falls
with the document's length; an item's vector holds the whole weight of each of its terms. The score is their
inner product. Two passes read the texts. The first counts documents, terms and, for each item term, the documents that
hold it; it moves one row per item term and task. In the second every task gathers a shard of documents at a time and
builds a ball tree over it. A node has a centre and a radius, and for an item q no score in it exceeds
``q.centre + |q'| * radius``, where q' is q on the terms that occur in the node: outside them the documents and the
centre agree, in zeros. Vectors are stretched by the root of the term weight on either side, which keeps
the products and makes rare terms count more in the radius. Bounds are computed in doubles and rounded up by far more than
the arithmetic can lose; leaves are scored in 64-bit integers. Nodes are taken best-first and the search of an item ends at
the first bound below its 50th score so far, which passes from shard to shard of a task. Equal bounds are still
searched, as an equal score with a smaller id ranks higher.

Items are a query set. They are broadcast in blocks of bounded bytes, with two passes per block; inside a task
a block is searched in chunks, so that the dense tables of a chunk stay small.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from nightledger.llm.frames import cut_lineage
from nightledger.llm.words import ALNUM, Words, buffers, slabs

TOP = 50
BLOCK_BYTES = 2 << 20
CHUNK_ITEMS, CHUNK_TERMS = 128, 8192
SHARD_ROWS, SHARD_ENTRIES = 2048, 1 << 20
LEAF = 32
SALTS = 32
SAFETY = 1e-9  # relative; sums of 10,000 products in doubles lose less than 1e-11
NO_ID = np.iinfo(np.int64).max
N_DOCS, N_TERMS = -1, -2


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indexes ``start[i] .. start[i] + size[i] - 1`` of all i, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Block:
    """Items as a sorted vocabulary of word hashes and the distinct (item, term) pairs."""

    def __init__(self, ids: list, texts: list[str]):
        data, offsets = buffers(pa.array(texts, pa.large_string()))
        words = Words(data, offsets, ALNUM, lower=True)
        self.one, first, number = np.unique(words.hashes(0), return_index=True, return_inverse=True)
        self.two = words.hashes(1)[first]
        if (self.two[number] != words.hashes(1)).any():
            raise ValueError("two terms share a hash")
        self.ids, self.terms = ids, len(self.one)
        pair = np.unique(words.text_of() * max(1, self.terms) + number)
        self.item, self.term = pair // max(1, self.terms), pair % max(1, self.terms)

    def entries(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, occurrences) of every item term in every text, by text and term."""
        if not self.terms or not len(words):
            return (np.empty(0, np.int64),) * 3
        one = words.hashes(0)
        at = np.minimum(np.searchsorted(self.one, one), self.terms - 1)
        known = np.flatnonzero(self.one[at] == one)
        known = known[self.two[at[known]] == words.hashes(1)[known]] if len(known) else known
        pair, count = np.unique(words.text_of()[known] * self.terms + at[known], return_counts=True)
        return pair // self.terms, pair % self.terms, count

    def chunks(self) -> Iterator[tuple[int, int]]:
        """Ranges of items, bounded in items and in (item, term) pairs unless it is one item."""
        first = np.searchsorted(self.item, np.arange(len(self.ids) + 1))
        lo = 0
        while lo < len(self.ids):
            hi = lo + 1
            while hi < len(self.ids) and hi - lo < CHUNK_ITEMS and first[hi + 1] - first[lo] <= CHUNK_TERMS:
                hi += 1
            yield lo, hi
            lo = hi


class Vectors:
    """Sparse rows: entries ``first[i]:first[i + 1]`` of row i, with term, whole value and stretched value."""

    def __init__(self, ids, size, term, value, stretched):
        self.ids, self.size, self.term, self.value, self.stretched = ids, size, term, value, stretched
        self.first = np.concatenate([[0], np.cumsum(size)])

    def take(self, rows: np.ndarray) -> Vectors:
        at = _ragged(self.first[rows], self.size[rows])
        return Vectors(self.ids[rows], self.size[rows], self.term[at], self.value[at], self.stretched[at])

    def sums(self, entries: np.ndarray) -> np.ndarray:
        """Sum over each row; no row is empty."""
        return np.add.reduceat(entries, self.first[:-1])

    def dense(self, row: int, terms: int) -> np.ndarray:
        out = np.zeros(terms)
        own = slice(self.first[row], self.first[row + 1])
        out[self.term[own]] = self.stretched[own]
        return out


class Tree:
    """A balanced ball tree: centre, radius and occurring terms of each node, vectors at the leaves."""

    def __init__(self, vectors: Vectors, terms: int):
        self.children: list[tuple[int, int] | None] = []
        self.leaf: list[Vectors | None] = []
        centres, held, radius = [], [], []
        waiting = [(vectors, -1)]
        while waiting:
            own, parent = waiting.pop()
            node = len(self.leaf)
            if parent >= 0:
                left = self.children[parent]
                self.children[parent] = (node,) if left is None else (*left, node)
            n = len(own.ids)
            centre = np.bincount(own.term, own.stretched, terms) / n
            square = own.sums(own.stretched**2)
            middle = centre @ centre
            away = square - 2 * own.sums(own.stretched * centre[own.term]) + middle
            centres.append(centre)
            held.append(np.bincount(own.term, minlength=terms) > 0)
            radius.append(np.sqrt(max(away.max(), 0) + SAFETY * (square.max() + middle)))
            self.children.append(None)
            self.leaf.append(own if n <= LEAF else None)
            if n <= LEAF:
                continue
            far = own.dense(int(away.argmax()), terms)
            gap = square - 2 * own.sums(own.stretched * far[own.term])
            direction = own.dense(int(gap.argmax()), terms) - far
            order = np.argsort(own.sums(own.stretched * direction[own.term]), kind="stable")
            waiting += [(own.take(np.sort(half)), node) for half in (order[: n // 2], order[n // 2 :])]
        self.centres, self.held = np.array(centres), np.array(held)
        self.radius = np.array(radius)

    def bounds(self, weights: np.ndarray) -> np.ndarray:
        """Upper bound of the score of each item (row of whole weights) in each node, rounded up."""
        weights = weights.T.astype(np.float64)
        inner = self.centres @ np.sqrt(weights)
        spread = np.sqrt(self.held.astype(np.float64) @ weights) * self.radius[:, None]
        return (inner + spread) * (1 + SAFETY) + 1


class Best:
    """The ``top`` highest scores of one item, equal ones by id."""

    def __init__(self, top: int):
        self.top, self.scores, self.ids, self.bar = top, np.empty(0, np.int64), np.empty(0, np.int64), 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.bar
        if not good.any():
            return
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.top]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.top:
            self.bar = int(self.scores[-1])


def search(tree: Tree, weights: np.ndarray, best: list[Best]) -> int:
    """Offer each item the documents of the tree that can be among its best; the number of rows scored."""
    bounds, scored = tree.bounds(weights), 0
    for item, found in enumerate(best):
        own = bounds[:, item]
        queue = [(-own[0], 0)]
        while queue and -queue[0][0] >= found.bar:
            node = heapq.heappop(queue)[1]
            leaf = tree.leaf[node]
            if leaf is None:
                for child in tree.children[node]:
                    if own[child] >= found.bar:
                        heapq.heappush(queue, (-own[child], child))
            else:
                found.add(leaf.sums(leaf.value * weights[item][leaf.term]), leaf.ids)
                scored += len(leaf.ids)
    return scored


class Searcher:
    """The best documents so far of every item of a block, and the shard that is being gathered."""

    def __init__(self, block: Block, weights: np.ndarray, n_docs: int, n_terms: int, top: int):
        self.block, self.weights, self.n_docs, self.n_terms = block, weights, n_docs, n_terms
        self.best = [Best(top) for _ in block.ids]
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = self.entries = self.scored = 0

    def add(self, words: Words, ids: np.ndarray) -> None:
        text, term, count = self.block.entries(words)
        useful = self.weights[term] > 0
        text, term, count = text[useful], term[useful], count[useful]
        if not len(text):
            return
        length = 50 + self._relative(words.counts)
        value = (1_000_000_000 * count) // (1000 * count + 20 * length[text])
        own, size = np.unique(text, return_counts=True)
        self.parts.append((ids[own], size, term, value))
        self.rows += len(own)
        self.entries += len(term)
        if self.rows >= SHARD_ROWS or self.entries >= SHARD_ENTRIES:
            self.flush()

    def _relative(self, counts: np.ndarray) -> np.ndarray:
        most = int(counts.max(initial=0))
        if 50 * most * self.n_docs < 1 << 63:
            return 50 * counts * self.n_docs // self.n_terms
        return np.array([50 * int(n) * self.n_docs // self.n_terms for n in counts], np.int64)

    def flush(self) -> None:
        """Search the gathered shard, a chunk of items at a time."""
        if not self.parts:
            return
        ids, size, term, value = (np.concatenate(a) for a in zip(*self.parts, strict=True))
        self.parts, self.rows, self.entries = [], 0, 0
        row = np.repeat(np.arange(len(ids)), size)
        block = self.block
        for lo, hi in block.chunks():
            pairs = slice(*np.searchsorted(block.item, [lo, hi]))
            terms, column = np.unique(block.term[pairs], return_inverse=True)
            if not len(terms):
                continue
            local = np.full(block.terms, -1)
            local[terms] = np.arange(len(terms))
            own = np.flatnonzero(local[term] >= 0)
            if not len(own):
                continue
            rows, sizes = np.unique(row[own], return_counts=True)
            weights = np.zeros((hi - lo, len(terms)), np.int64)
            weights[block.item[pairs] - lo, column] = self.weights[block.term[pairs]]
            stretched = value[own] * np.sqrt(self.weights[term[own]])
            tree = Tree(Vectors(ids[rows], sizes, local[term[own]], value[own], stretched), len(terms))
            self.scored += search(tree, weights, self.best[lo:hi])


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Block]:
    """Distinct items with a text, a bounded part at a time."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(total) // block_bytes))
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for part in range(parts):
        rows = items.where(F.col("text").isNotNull() & (key == part)).select("item_id", "text").distinct().collect()
        if rows:
            yield Block([r[0] for r in rows], [r[1] for r in rows])


def _statistics(docs: DataFrame, block: Block) -> dict[int, int]:
    """Documents that hold each item term, under its number; all documents with terms and all their terms."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        holding, n_docs, n_terms = np.zeros(own.terms, np.int64), 0, 0
        for batch in batches:
            for _, _, data, offsets in slabs(batch.column("text")):
                words = Words(data, offsets, ALNUM, lower=True)
                n_docs += int((words.counts > 0).sum())
                n_terms += len(words)
                holding += np.bincount(own.entries(words)[1], minlength=own.terms)
        term = np.concatenate([np.flatnonzero(holding), [N_DOCS, N_TERMS]])
        n = np.concatenate([holding[holding > 0], [n_docs, n_terms]])
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], names=["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    shared.destroy()
    return {r.term: r.n for r in rows}


def _candidates(docs: DataFrame, block: Block, top: int) -> DataFrame:
    """item (number in the block), doc_id and score of the best documents of each task."""
    known = _statistics(docs, block)
    n_docs, n_terms = known.get(N_DOCS, 0), known.get(N_TERMS, 0)
    holding = np.array([known.get(t, 0) for t in range(block.terms)], np.float64)
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * holding + 1))).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast((block, weights))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_weights = shared.value
        searcher = Searcher(own, own_weights, n_docs, n_terms, top)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            for lo, hi, data, offsets in slabs(batch.column("text")):
                searcher.add(Words(data, offsets, ALNUM, lower=True), ids[lo:hi])
        searcher.flush()
        for number, found in enumerate(searcher.best):
            if len(found.ids):
                columns = [np.full(len(found.ids), number), found.ids, found.scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["item", "doc_id", "score"])

    return docs.mapInArrow(scan, "item long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` documents with the highest score above 0 for each item.

    Terms are the longest runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Equal scores are
    ranked by doc_id, a null one last (the largest long counts as null). Null and empty texts and texts without
    terms hold nothing; such items have no rows. Rows of ``docs`` are documents each, also under one id. Items
    that agree in id and text are one; one id with two texts is ranked for each. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = items.select("item_id", "text")
    parts, names = [], []
    for number, block in enumerate(_blocks(items, block_bytes)):
        if parts:  # one block alive at a time
            parts[-1] = cut_lineage(parts[-1])
        parts.append(_candidates(docs, block, top).withColumn("block", F.lit(number)))
        names += [(number, i, name) for i, name in enumerate(block.ids)]
    item_id = StructField("item_id", items.schema["item_id"].dataType)
    named = StructType([StructField("block", IntegerType()), StructField("item", LongType()), item_id])
    empty = spark.createDataFrame([], "item long, doc_id long, score long, block int")
    found = reduce(DataFrame.union, parts, empty) if len(parts) != 1 else parts[0]
    order = [F.desc("score"), F.asc("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    some = Window.partitionBy("block", "item", "salt").orderBy(*order)
    found = found.withColumn("salt", salt).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    last = Window.partitionBy("block", "item").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top)
    found = found.join(spark.createDataFrame(names, named), ["block", "item"])
    return found.select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
