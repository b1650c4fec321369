"""SetSketch registers of shingle sets, and near-duplicate groups found with them.

A register holds, on an exponential scale of base ``BASE``, the smallest of exponentially distributed
hash values of a set's elements. Registers of a union are the larger of the parts' registers, and two
sets agree in a register with a probability close to their Jaccard similarity.

Documents with equal sets form one class; from then on only the class of the smallest id counts. Classes
that agree in all registers of a band share a bucket. Each class is first compared with the smallest class among
its buckets; the groups found so make most buckets uniform. In the buckets that still hold several groups, all pairs
across groups are estimated, in blocks of bounded size and without being written out. Pairs are judged by
a joint likelihood estimate first and confirmed on the full sets, those across groups inside their block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightledger.llm.components import components
from nightledger.llm.frames import Carried, cut_lineage
from nightledger.llm.words import SPACED, Words, mix, runs, slabs, window_hashes, window_starts

SHINGLE = 5
REGISTERS, BASE, RATE, TOP = 128, 1.001, 20.0, 65535
BAND = 4
SIMILAR = 75  # in hundredths
SLACK = 0.20  # an estimate this far below is over five standard errors off
LEAST_EQUAL = 40  # equal registers; sets similar to 55 percent agree in 70 on average, with a deviation below 6
GROUP_ROWS, GROUP_BYTES, PAIRS_AT_ONCE = 8192, 32 << 20, 1 << 16
BROADCAST_BYTES = 8 << 20
BLOCK = 512  # members of a bucket that meet in one task

_RNG = np.random.Generator(np.random.PCG64(7))
_SCALE = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_BAND_STEPS = _RNG.integers(1, 1 << 63, BAND, dtype=np.uint64) | np.uint64(1)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted within the text, and where each text's begin.

    A text with fewer words has its whole word sequence as one shingle; without words it has none.
    """
    hashes, text = words.hashes(0), words.text_of()
    starts = window_starts(words, size)
    values, owner = [window_hashes(hashes, starts, size)], [text[starts]]
    for short in range(1, size):
        own = np.flatnonzero(words.counts == short)
        values.append(mix(window_hashes(hashes, words.first[own], short) + np.uint64(short)))
        owner.append(own)
    text = np.concatenate(owner)
    order = np.argsort(text, kind="stable")
    values, text = np.concatenate(values)[order], text[order]
    first = np.searchsorted(text, np.arange(len(words.counts) + 1))
    for lo, hi in zip(first[:-1], first[1:], strict=True):
        values[lo:hi].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[new], np.searchsorted(text[new], np.arange(len(words.counts) + 1))


def registers(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Registers of each set, a row each; the empty set has zeros."""
    out = np.zeros((len(first) - 1, REGISTERS), np.uint16)
    full = np.flatnonzero(np.diff(first))
    if not len(full):
        return out
    x = (values >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(full), REGISTERS), np.uint32)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat(x * _SCALE[i] + _SHIFT[i], first[:-1][full])
    waiting = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    out[full] = np.clip(np.floor(1 - np.log(waiting) / np.log(BASE)), 0, TOP)
    return out


def merge(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(one, two)


def bands(rows: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of registers."""
    parts = rows.reshape(len(rows), REGISTERS // BAND, BAND).astype(np.uint64)
    total = np.arange(REGISTERS // BAND, dtype=np.uint64)[None, :] + np.uint64(1)
    for j in range(BAND):
        total = mix(total * _BAND_STEPS[j] + parts[:, :, j])
    return total


def similarity(more: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of sets with ``n`` and ``m`` elements.

    ``more`` and ``less`` count the registers in which the first set's value is larger or smaller.
    """
    u, v = n / (n + m), m / (n + m)
    equal = REGISTERS - more - less
    scale = (BASE - 1) / BASE

    def larger(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * scale) / np.log(BASE), 1e-12, 1)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = larger(u - v * j), larger(v - u * j)
        return more * np.log(up) + less * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(30):
        third = (hi - lo) / 3
        left = likelihood(lo + third) < likelihood(hi - third)
        lo, hi = np.where(left, lo + third, lo), np.where(left, hi, hi - third)
    return (lo + hi) / 2


def _sketched(docs: DataFrame) -> DataFrame:
    """id, n_shingles, two sums that name the set, registers and band keys of each document."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text")):
                values, first = shingles(Words(data, offsets, SPACED, lower=True))
                count = np.diff(first)
                sums = []
                for salt in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
                    total = np.concatenate([[np.uint64(0)], np.cumsum(mix(values + np.uint64(salt)), dtype=np.uint64)])
                    sums.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
                rows = registers(values, first)
                keys = bands(rows).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(lo, hi - lo),
                        pa.array(count, pa.int64()),
                        *(pa.array(s) for s in sums),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel())
                        ),
                    ],
                    names=["id", "n_shingles", "sum1", "sum2", "registers", "bands"],
                )

    schema = "id long, n_shingles long, sum1 long, sum2 long, registers binary, bands array<long>"
    return docs.mapInArrow(sketch, schema)


def _likely(pairs: DataFrame) -> DataFrame:
    """Pairs a, b whose sizes and registers allow the similarity."""

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            one, two = (_rows(batch.column(c).to_pylist()) for c in ("ra", "rb"))
            n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
            est = similarity((one > two).sum(1), (one < two).sum(1), n, m)
            keep = pa.array(est >= SIMILAR / 100 - SLACK)
            yield batch.select(["a", "b"]).filter(keep)

    sized = pairs.where(100 * F.least("na", "nb") >= SIMILAR * F.greatest("na", "nb"))
    return sized.mapInArrow(estimate, "a long, b long")


def _rows(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint16).reshape(-1, REGISTERS)


def _likely_pairs(cells: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of likely similar rows of different groups in one cell, and their estimate; ``cells`` come sorted.

    Two sets that share several buckets meet in the one of the first band they agree in.
    """
    key, x, y, own, band, component, n = (cells[c].to_numpy() for c in "key x y own band component n".split())
    rows, at = _rows(list(cells["registers"])), np.arange(len(cells))
    new = np.ones(len(cells), bool)
    new[1:] = (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    cell = np.cumsum(new) - 1
    end = np.append(np.flatnonzero(new)[1:], len(cells))[cell]
    # a row meets those after it in its block, or those of the other block
    middle = end - np.bincount(cell, own == y)[cell].astype(np.int64)
    lo = np.where(x == y, at + 1, np.where(own == x, middle, end))
    count = end - lo
    edges = np.searchsorted(np.cumsum(count), np.arange(0, max(1, count.sum()), PAIRS_AT_ONCE), "left")
    for first, last in zip(edges, np.append(edges[1:], len(cells)), strict=True):
        some = count[first:last]
        left = np.repeat(at[first:last], some)
        right = lo[left] + np.arange(len(left)) - np.repeat(np.cumsum(some) - some, some)
        ok = component[left] != component[right]
        ok &= 100 * np.minimum(n[left], n[right]) >= SIMILAR * np.maximum(n[left], n[right])
        left, right = left[ok], right[ok]
        equal = rows[left] == rows[right]
        ok = equal.sum(1) >= LEAST_EQUAL
        ok &= equal.reshape(len(left), REGISTERS // BAND, BAND).all(2).argmax(1) == band[left]
        left, right = left[ok], right[ok]
        est = similarity((rows[left] > rows[right]).sum(1), (rows[left] < rows[right]).sum(1), n[left], n[right])
        ok = est >= SIMILAR / 100 - SLACK
        yield left[ok], right[ok], est[ok]


def _sorted(group: pd.DataFrame) -> pd.DataFrame:
    return group.sort_values(["key", "x", "y", "own", "id"], kind="stable").reset_index(drop=True)


def _cells(buckets: DataFrame) -> DataFrame:
    """Rows of ``buckets`` once for each cell; a bucket of more than ``BLOCK`` members has a cell per pair of blocks."""
    parts = F.ceil(F.col("members") / BLOCK).cast("int")
    cells = buckets.withColumn("own", F.pmod(F.xxhash64("id"), parts).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return cells.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")})


_CELL = ["key", "x", "y", "own", "band", "id", "component", "n", "members", "registers"]


def _dealt(cells: DataFrame, weight: str, limit: int) -> DataFrame:
    """``cells`` with the number of the task group their cell belongs to.

    A cell of a bucket cut into blocks is a group of its own; small cells share groups.
    """
    large = F.col("members") > BLOCK
    total = cells.agg(F.sum(F.when(~large, F.expr(weight)))).first()[0] or 0
    cell = F.xxhash64("key", "x", "y")
    shared = F.pmod(cell, F.lit(max(1, -(-int(total) // limit))))
    return cells.withColumn("deal", F.when(large, cell).otherwise(shared))


def _open_members(buckets: DataFrame) -> DataFrame:
    """key, x, y, own, id of the members of cells that are in a likely pair."""

    def involved(group: pd.DataFrame) -> pd.DataFrame:
        group = _sorted(group)
        hit = np.zeros(len(group), bool)
        for left, right, _ in _likely_pairs(group):
            hit[left] = hit[right] = True
        return group.loc[hit, ["key", "x", "y", "own", "id"]]

    cells = _dealt(_cells(buckets).select(*_CELL), "1", GROUP_ROWS)
    return cells.groupBy("deal").applyInPandas(involved, "key long, x int, y int, own int, id long")


def _links_across(members: DataFrame) -> DataFrame:
    """Confirmed links a, b that connect the groups within each cell; ``members`` has cells with ``grams``.

    A pair whose groups already hang together in the task is left out, so no more links come out than members.
    """

    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        group = _sorted(group)
        grams = [np.frombuffer(g, np.uint64) for g in group["grams"]]
        ids, component, up, found = group["id"].to_numpy(), group["component"].to_numpy(), {}, []

        def root(c: int) -> int:
            while up.setdefault(c, c) != c:
                up[c] = up[up[c]]
                c = up[c]
            return c

        for left, right, est in _likely_pairs(group):
            for k in np.argsort(-est, kind="stable"):
                i, j = left[k], right[k]
                one, two = root(component[i]), root(component[j])
                if one != two and _similar(grams[i], grams[j]):
                    up[two] = one
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    dealt = _dealt(members, "8 * n + 512", GROUP_BYTES)
    return dealt.groupBy("deal").applyInPandas(confirm, "a long, b long")


def _similar(one: np.ndarray, two: np.ndarray) -> bool:
    """Whether two sorted sets have the wanted similarity."""
    if len(one) > len(two):
        one, two = two, one
    both = int((two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one).sum()) if len(one) else 0
    return 100 * both >= SIMILAR * (len(one) + len(two) - both)


def _grams(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """id and sorted shingle hashes of the documents in ``ids``.

    Few ids go to the documents as a broadcast of checked size; many meet them in a shuffle.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text")):
                values, first = shingles(Words(data, offsets, SPACED, lower=True))
                grams = [values[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), pa.array(grams, pa.binary())], names=["id", "grams"]
                )

    needed = cut_lineage(ids.select("id").distinct())
    if needed.count() * 8 <= BROADCAST_BYTES:
        needed = F.broadcast(needed)
    return docs.join(needed, "id", "left_semi").mapInArrow(sets, "id long, grams binary")


def _confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs that are similar by their full sets."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column("ga"), batch.column("gb"), strict=True)
            keep = [_similar(*(np.frombuffer(v.as_buffer(), np.uint64) for v in pair)) for pair in sides]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    grams = cut_lineage(_grams(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs))
    right = pairs.join(grams.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
    both = right.join(grams.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
    return both.select("a", "b", "ga", "gb").mapInArrow(judge, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked if their sets of distinct five-word shingles (A-Z lower-cased) are similar to 75 percent;
    component_id is the smallest doc_id reachable, kept marks the document that has it. Null and empty texts have
    no shingles and no links. A row without id has no links and is kept. Rows that share an id are one
    document with several texts. Columns other than doc_id and text are ignored.
    """
    kind = docs.schema["doc_id"].dataType
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    sketched = cut_lineage(_sketched(texts))
    named = sketched.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    name = ["n_shingles", "sum1", "sum2"]
    classes = named.groupBy(*name).agg(
        F.min("id").alias("id"), F.first("registers").alias("registers"), F.first("bands").alias("bands")
    )
    classes = cut_lineage(classes)
    entries = classes.select("id", F.posexplode("bands").alias("band", "key"))
    heads = entries.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("members")).where("members > 1")
    buckets = cut_lineage(entries.join(heads, "key"))
    size = classes.select("id", F.col("n_shingles").alias("n"), "registers")
    side = {s: size.select(F.col("id").alias(s), F.col("n").alias(f"n{s}"), F.col("registers").alias(f"r{s}")) for s in "ab"}

    first = buckets.where("id != head").groupBy(F.col("id").alias("b")).agg(F.min("head").alias("a"))
    tried = cut_lineage(_likely(first.join(side["b"], "b").join(side["a"], "a")))
    links = cut_lineage(_confirmed(tried, texts))

    group = components(links)
    labelled = buckets.join(group, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    labelled = cut_lineage(labelled.join(mixed.select("key"), "key", "left_semi"))
    open_ = cut_lineage(_open_members(labelled.join(size, "id")))
    rows = labelled.select("key", "band", "id", "component", "members").join(size, "id")
    members = open_.join(rows, ["key", "id"]).join(_grams(open_, texts), "id")
    links = links.union(_links_across(members))

    same = named.join(classes.select(*name, F.col("id").alias("head")), name).select(F.col("head").alias("a"), F.col("id").alias("b"))
    group = components(links.union(same))
    out = sketched.join(group, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).cast(kind)
    return out.select(
        F.col("id").cast(kind).alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group: the rows of ``docs`` with the kept ids, and those without id. Columns may have any names."""
    carried = Carried(docs, "doc_id", "text")
    dropped = near_duplicates(carried.work.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return carried.back(carried.work.join(dropped, "doc_id", "left_anti"))
