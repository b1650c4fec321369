"""Benchmark decontamination by suffix arrays over shards of the training documents.

Each shard (a slab of documents inside a task) becomes one sequence of word numbers. Its suffixes are
sorted by their first ``window`` words, and every suffix of every benchmark item is looked up by binary
search, which gives all verbatim matches with their places. Only suffixes that can match are sorted:
those followed by as many benchmark words as the shortest item needs. Overlapping matches of one item are
joined to the longest one.

Benchmark items are a query set, not corpus data. They are broadcast in blocks of bounded bytes, one pass
over the documents per block. What a pass finds is written to the shared folder and its block is destroyed before
the next one is built, so one block is alive at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.frames import Carried, cut_lineage
from nightledger.llm.words import ALNUM, Words, buffers, slabs

WINDOW = 13
BLOCK_BYTES = 8 << 20
MATCH = "array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"
MATCH_TYPE = pa.struct(
    [("item_id", pa.string()), ("item_start", pa.int32()), ("doc_start", pa.int32()), ("n_words", pa.int32())]
)


class Block:
    """Benchmark items as sorted vocabulary and packed query suffixes."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        data, offsets = buffers(pa.array(texts, pa.large_string()))
        words = Words(data, offsets, ALNUM, lower=True)
        one, two = words.hashes(0), words.hashes(1)
        order = np.lexsort((two, one))
        pair = np.stack([one[order], two[order]], 1)
        new = np.ones(len(order), bool)
        new[1:] = (pair[1:] != pair[:-1]).any(1)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new)
        self.one, self.two = one[order][new], two[order][new]
        self.ids, self.window = ids, window
        self.bits = max(1, int(len(self.one)).bit_length())
        item = words.text_of()
        place = np.arange(len(words)) - words.first[:-1][item]
        length = np.minimum(window, words.counts[item])
        start = np.flatnonzero(place + length <= words.counts[item])
        self.item, self.place, self.length = item[start], place[start], length[start]
        self.shortest = int(self.length.min()) if len(start) else 0
        low = np.zeros((len(start), window), np.int64)
        high = np.full((len(start), window), (1 << self.bits) - 1, np.int64)
        for j in range(window):
            own = self.length > j
            low[own, j] = high[own, j] = number[start[own] + j]
        self.low, self.high = self.pack(low), self.pack(high)

    def pack(self, numbers: np.ndarray) -> np.ndarray:
        """Word numbers of each row as one byte string that sorts in their order."""
        per = 64 // self.bits
        firsts = range(0, numbers.shape[1], per)
        keys = np.zeros((len(numbers), len(firsts)), ">u8")
        for k, at in enumerate(firsts):
            key = np.zeros(len(numbers), np.uint64)
            for j in range(at, at + per):
                key <<= np.uint64(self.bits)
                if j < numbers.shape[1]:
                    key |= numbers[:, j].astype(np.uint64)
            keys[:, k] = key
        return keys.view(f"S{8 * len(firsts)}").ravel()

    def number(self, words: Words) -> np.ndarray:
        """Vocabulary number of each word, 0 for words of no item."""
        one = words.hashes(0)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        known = np.flatnonzero(self.one[at] == one)
        out = np.zeros(len(one), np.int64)
        if len(known):
            same = self.two[at[known]] == words.hashes(1)[known]
            out[known[same]] = at[known[same]] + 1
        return out

    def matches(self, words: Words) -> tuple[np.ndarray, ...]:
        """Longest matches as arrays: text, place in the text, item, place in the item, number of words."""
        none = (np.empty(0, np.int64),) * 5
        if not len(self.item) or not len(words):
            return none
        text = words.text_of()
        sequence = np.zeros(len(words) + len(words.counts) + self.window, np.int64)  # 0 after every text
        sequence[np.arange(len(words)) + text] = self.number(words)
        stop = np.flatnonzero(sequence == 0)
        where = np.flatnonzero(sequence)
        where = where[stop[np.searchsorted(stop, where)] - where >= self.shortest]
        if not len(where):
            return none
        keys = self.pack(sequence[where[:, None] + np.arange(self.window)])
        order = np.argsort(keys, kind="stable")
        suffixes, keys = where[order], keys[order]
        low, high = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        found = high - low
        query = np.repeat(np.arange(len(low)), found)
        if not len(query):
            return none
        within = np.arange(len(query)) - np.repeat(np.cumsum(found) - found, found)
        at = suffixes[low[query] + within]
        item, place = self.item[query], self.place[query]
        order = np.lexsort((at, at - place, item))
        at, item, place = at[order], item[order], place[order]
        shift = at - place
        head = np.ones(len(at), bool)
        head[1:] = (item[1:] != item[:-1]) | (shift[1:] != shift[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(at))) - 1 + self.length[query[order]][first]
        at, item, place = at[first], item[first], place[first]
        starts = words.first[:-1] + np.arange(len(words.counts))  # place of each text in the sequence
        text = np.searchsorted(starts, at, "right") - 1
        return text, at - starts[text], item, place, size


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[tuple[Block, bool]]:
    """Items with words, a bounded part at a time, and whether it is the last part."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-int(total) // block_bytes))
    key = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for part in range(parts):
        rows = benchmark.where(F.col("text").isNotNull() & (key == part))
        rows = rows.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").distinct().collect()
        ids, texts = [r[0] for r in rows], [r[1] for r in rows]
        del rows
        if ids or parts == 1:
            yield Block(ids, texts, window), part == parts - 1


def benchmark_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The columns of ``docs`` with n_words and the array ``matches`` of longest verbatim matches.

    ``docs`` needs a column text; a column of it named n_words or matches is replaced. A match has at
    least ``window`` words, or is a whole item that is shorter. Null and empty texts have no words and no matches;
    items without words match nothing; an item without id has the id ''; repeated rows are judged each.
    """
    spark = docs.sparkSession
    carried = Carried(docs, "text")
    out = carried.work.withColumns({"n_words": F.lit(0).cast("long"), "matches": F.array().cast(MATCH)})
    schema = out.schema

    def searched(shared: Broadcast) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, data, offsets in slabs(batch.column("text")):
                    words = Words(data, offsets, ALNUM, lower=True)
                    old = batch.column("matches").slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).slice(lo, hi - lo) for c in ("row", "text")]
                        + [pa.array(words.counts, pa.int64()), _appended(old, shared.value, words)],
                        names=schema.names,
                    )

        return out.mapInArrow(scan, schema)

    for block, last in _blocks(benchmark, window, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        del block
        out = searched(shared)
        if not last:
            out = cut_lineage(out)
            shared.destroy()
    return carried.back(out, {"n_words": F.col("n_words"), "matches": F.col("matches")})


def _appended(old: pa.ListArray, block: Block, words: Words) -> pa.ListArray:
    """The lists of ``old``, each followed by the matches of the block in its text."""
    text, at, item, place, size = block.matches(words)
    counts = np.diff(old.offsets.to_numpy())
    values = old.flatten()
    owner = np.concatenate([np.repeat(np.arange(len(old)), counts), text])
    new = pa.StructArray.from_arrays(
        [
            pa.array(block.ids, pa.string()).take(pa.array(item)),
            pa.array(place, pa.int32()),
            pa.array(at, pa.int32()),
            pa.array(size, pa.int32()),
        ],
        fields=list(MATCH_TYPE),
    )
    order = np.argsort(owner, kind="stable")
    values = pa.concat_arrays([values.cast(MATCH_TYPE), new]).take(pa.array(order))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(old)))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **options: int) -> DataFrame:
    """The columns of ``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    A word is hit if a match covers it; a document is contaminated if it has hit words and they are at
    least one twentieth of its words. Columns of ``docs`` with one of these names are replaced.
    """
    carried = Carried(docs, "text")
    found = benchmark_matches(carried.work, benchmark, window, **options)
    spans = F.array_sort(
        F.transform("matches", lambda m: F.struct(m.doc_start.alias("lo"), (m.doc_start + m.n_words).alias("hi")))
    )

    def cover(state, span):
        hi = F.greatest(state.hi, span.hi)
        return F.struct((state.hit + hi - F.greatest(span.lo, F.least(state.hi, hi))).alias("hit"), hi.alias("hi"))

    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("hi"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m.item_id)))
    hit = found.withColumn("n_hit", F.aggregate(spans, start, cover, lambda s: s.hit))
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return carried.back(
        hit,
        {
            "n_words": F.col("n_words"),
            "n_hit": F.col("n_hit"),
            "n_items": F.size(items).cast("long"),
            "items_sha256": F.sha2(F.concat_ws(",", items), 256),
            "contaminated": contaminated,
        },
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options: int) -> DataFrame:
    """``docs`` without contaminated documents, with its own columns only, whatever they are called."""
    carried = Carried(docs, "text")
    return carried.back(contamination(carried.work, benchmark, **options).where(~F.col("contaminated")))
