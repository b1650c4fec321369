"""Removal of passages that an earlier document has, with a count-min prefilter.

Texts are dealt over homes of bounded bytes, once; all passes read that one shuffle.

Pass 1 counts the windows of ``WINDOW`` words of each home in a count-min sketch. A sketch row is cut into blocks
of cells, as many as keep ``LOAD`` windows a cell at any size of the corpus. The sketches of all homes are merged
block by block, each in a task, so counts are never too low. Only "at least two" matters, so counters stop
at two. Each home hears which of its own cells hold two or more; no process holds a whole sketch.

Pass 2 groups exactly the windows that the sketch holds for repeated, by 96 bits of hash. A home first decides among
its own documents: of each window only the smallest document's claim is sent on, so a passage that a
third of all documents share is sent once per home, not once per document.

Pass 3 brings each document together with the windows it loses and keeps the other words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nightledger.llm.frames import Carried
from nightledger.llm.packed import pack, steps, unpack
from nightledger.llm.words import SPACED, Words, runs, slabs, window_hashes, window_starts

WINDOW = 13
ROWS = 2
LOAD = 0.5  # windows for each cell of a row
BLOCK_BITS = 22  # a block has 2 ** BLOCK_BITS cells; merging one takes a byte a cell
HOME_BYTES = BUCKET_BYTES = 6 << 20
WORD_BYTES = 6  # with the blank; only sizes the sketch
NO_ID = np.iinfo(np.int64).max


def _window_keys(texts: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row and place of each window of ``size`` words, and a hash of it for each row of the sketch."""
    rows, places, keys, base = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [], 0
    for batch in texts.to_batches():
        for lo, _, data, offsets in slabs(batch.column("text")):
            words = Words(data, offsets, SPACED)
            starts = window_starts(words, size)
            text = words.text_of()[starts]
            rows.append(text + (base + lo))
            places.append((starts - words.first[text]).astype(np.int32))
            keys.append([window_hashes(words.hashes(r), starts, size, r) for r in range(ROWS)])
        base += len(batch)
    none = [np.empty(0, np.uint64)]
    return np.concatenate(rows), np.concatenate(places), [np.concatenate(none + [k[r] for k in keys]) for r in range(ROWS)]


def _cells(keys: np.ndarray, blocks: int, bits: int) -> np.ndarray:
    """Cell of each window: its block above the lowest ``bits`` bits, its place in the block in these."""
    half = np.uint64(32)
    block = ((keys >> half) * np.uint64(blocks)) >> half
    return (block << np.uint64(bits)) | ((keys & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - bits))


_SKETCH = pa.schema([("row", pa.int32()), ("block", pa.int64()), ("home", pa.int32()), ("payload", pa.binary())])


def repeated_cells(homes: DataFrame, blocks: int, size: int = WINDOW) -> DataFrame:
    """home, row, block and payload: of the cells that a home has in a block, in order, a bit each whether the windows
    counted there in all homes may be two or more. Blocks without such a cell are left out.
    """
    bits = BLOCK_BITS

    def count(texts: pa.Table) -> pa.Table:
        _, _, keys = _window_keys(texts, size)
        home, out = texts.column("home")[0].as_py(), []
        for row in range(ROWS):
            cells, n = np.unique(_cells(keys[row], blocks, bits), return_counts=True)
            for block, at in _split(cells >> np.uint64(bits)):
                own = (cells[at] & np.uint64((1 << bits) - 1)).astype(np.uint32)
                payload = pack(steps(own), steps(np.flatnonzero(n[at] > 1).astype(np.uint32)))
                out.append({"row": row, "block": block, "home": home, "payload": payload})
        return pa.Table.from_pylist(out, _SKETCH)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        counts, seen = np.zeros(1 << bits, np.uint8), []
        for payload in group["payload"]:
            own, more = (np.cumsum(x, dtype=np.int64) for x in unpack(payload))
            counts[own] = np.minimum(counts[own] + 1, 2)
            counts[own[more]] = 2
            seen.append(own)
        out = []
        for home, row, block, own in zip(group["home"], group["row"], group["block"], seen, strict=True):
            repeated = counts[own] == 2
            if repeated.any():
                out.append((home, row, block, pack(np.packbits(repeated, bitorder="little"))))
        return pd.DataFrame(out, columns=["home", "row", "block", "payload"])

    partial = homes.groupBy("home").applyInArrow(count, "row int, block long, home int, payload binary")
    return partial.groupBy("row", "block").applyInPandas(merge, "home int, row int, block long, payload binary")


def _repeated(keys: list[np.ndarray], heard: pa.Table, blocks: int, bits: int) -> np.ndarray:
    """Which windows of a home are held for repeated by all rows of the sketch."""
    out = np.ones(len(keys[0]), bool)
    for row in range(ROWS):
        cells, at = np.unique(_cells(keys[row], blocks, bits), return_inverse=True)
        hit = np.zeros(len(cells), bool)
        own = heard.filter(pa.compute.equal(heard.column("row"), row))
        for block, payload in zip(own.column("block").to_pylist(), own.column("payload").to_pylist(), strict=True):
            lo, hi = np.searchsorted(cells, np.array([block << bits, (block + 1) << bits], np.uint64))
            (flags,) = unpack(payload)
            hit[lo:hi] = np.unpackbits(flags, count=hi - lo, bitorder="little")
        out &= hit[at]
    return out


def _by_document(ids: np.ndarray, marks: np.ndarray, homes: np.ndarray, places: np.ndarray, *more: np.ndarray) -> bytes:
    """Windows of documents as bytes; rows come sorted by document and place."""
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])
    head = np.flatnonzero(new)
    counts = np.diff(np.append(head, len(ids))).astype(np.int32)
    return pack(ids[head], marks[head], homes[head], counts, steps(places), *more)


def _windows(payload: bytes) -> list[np.ndarray]:
    ids, marks, homes, counts, places, *more = unpack(payload)
    return [*(np.repeat(x, counts) for x in (ids, marks, homes)), np.cumsum(places, dtype=np.int32), *more]


def _split(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value with the indexes of its rows, in order."""
    if not len(keys):
        return
    order = np.argsort(keys, kind="stable")
    head = runs(keys[order])
    for lo, hi in zip(head, np.append(head[1:], len(order)), strict=True):
        yield int(keys[order[lo]]), order[lo:hi]


_MOVED = pa.schema([("bucket", pa.int32()), ("home", pa.int32()), ("payload", pa.binary())])


def _claims(one, two, ids, marks, homes, places, buckets: int) -> pa.Table:
    """Decide among the windows of one home; what is open goes to the window's bucket."""
    order = np.lexsort((ids, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    first = np.empty(len(order), bool)
    first[order] = ids[order] == least
    rows = []
    open_ = np.flatnonzero(first)
    for bucket, at in _split(one[open_] % np.uint64(buckets)):
        at = open_[at]
        payload = _by_document(ids[at], marks[at], homes[at], places[at], one[at], two[at])
        rows.append({"bucket": bucket, "home": None, "payload": payload})
    rows += _losses(ids, marks, homes, places, np.flatnonzero(~first), buckets)
    return pa.Table.from_pylist(rows, _MOVED)


def _losses(ids, marks, homes, places, lost, buckets: int) -> list[dict]:
    return [
        {"bucket": home % buckets, "home": home, "payload": _by_document(*(x[lost[at]] for x in (ids, marks, homes, places)))}
        for home, at in _split(homes[lost])
    ]


def _lost_windows(homes: DataFrame, blocks: int, buckets: int, size: int) -> DataFrame:
    """home and payload: the windows each document loses."""
    bits = BLOCK_BITS

    def claim(texts: pa.Table, heard: pa.Table) -> pa.Table:
        if not len(texts) or not len(heard):
            return _MOVED.empty_table()
        rows, places, keys = _window_keys(texts, size)
        at = np.flatnonzero(_repeated(keys, heard, blocks, bits))
        ids = texts.column("doc").combine_chunks().fill_null(NO_ID).to_numpy()
        marks, own = (texts.column(c).to_numpy() for c in ("mark", "home"))
        two = (keys[1][at] >> np.uint64(16)).astype(np.uint32)
        rows = rows[at]
        return _claims(keys[0][at], two, ids[rows], marks[rows], own[rows], places[at], buckets)

    def settle(group: pd.DataFrame) -> pd.DataFrame:
        decided = group["home"].notna()
        out = [group.loc[decided, ["home", "payload"]].astype({"home": "int32"})]
        parts = [_windows(x) for x in group.loc[~decided, "payload"]]
        if parts:
            ids, marks, homes, places, one, two = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((ids, two, one))
            new = np.ones(len(order), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
            least = ids[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            lost = order[ids[order] > least]
            lost = lost[np.lexsort((places[lost], marks[lost], ids[lost]))]
            rows = _losses(ids, marks, homes, places, lost, buckets)
            out.append(pd.DataFrame(rows, columns=["bucket", "home", "payload"])[["home", "payload"]])
        return pd.concat(out).astype({"home": "int32"})

    heard = repeated_cells(homes, blocks, size)
    pairs = homes.groupBy("home").cogroup(heard.groupBy("home"))
    moved = pairs.applyInArrow(claim, "bucket int, home int, payload binary")
    return moved.groupBy("bucket").applyInPandas(settle, "home int, payload binary")


def _covered(words: Words, lost: dict[int, list[np.ndarray]], size: int) -> np.ndarray:
    """Which words lie in a lost window; ``lost`` has the window places of texts by their number."""
    change = np.zeros(len(words) + 1, np.int64)
    for text, places in lost.items():
        at = words.first[text] + np.unique(np.concatenate(places)).astype(np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + size, -1)
    return np.cumsum(change[:-1]) > 0


def _kept_texts(words: Words, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the kept words of each text, joined by one blank."""
    start, length = words.start[keep], (words.end - words.start)[keep] + 1
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    source = np.repeat(start - (ends - length), length) + np.arange(len(out))
    out[:] = np.append(words.data, np.uint8(32))[source]
    out[ends - 1] = 32
    counts = np.add.reduceat(np.append(keep, False), words.first[:-1]) if len(words.counts) else np.empty(0, np.int64)
    counts = np.where(words.counts > 0, counts, 0)
    return out, np.concatenate([[0], np.append(0, ends)[np.cumsum(counts)]])


def _cleaned(docs: DataFrame, size: int, fill, schema: str | StructType) -> DataFrame:
    """Each document with what ``fill`` makes of its batch, its words and the words it keeps."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // int(WORD_BYTES * LOAD * (1 << BLOCK_BITS))))
    homes, buckets = (max(1, -(-int(total) // limit)) for limit in (HOME_BYTES, BUCKET_BYTES))
    keyed = docs.withColumns({"doc": F.col("doc_id").cast("long"), "mark": F.xxhash64("text")})
    # equal rows are dealt by the task that reads them, so that they do not all meet in one home
    home = F.pmod(F.xxhash64("doc", "mark", F.spark_partition_id()), F.lit(homes)).cast("int")
    keyed = keyed.withColumn("home", home)
    lost = _lost_windows(keyed, blocks, buckets, size)

    def strip(texts: pa.Table, decided: pa.Table) -> pa.Table:
        by_key: dict[tuple[int, int], list[np.ndarray]] = {}
        for payload in decided.column("payload").to_pylist():
            ids, marks, _, counts, places = unpack(payload)
            cuts = np.cumsum(counts)[:-1]
            for key_id, key_mark, own in zip(ids, marks, np.split(np.cumsum(places, dtype=np.int32), cuts), strict=True):
                by_key.setdefault((int(key_id), int(key_mark)), []).append(own)
        out = []
        for batch in texts.to_batches() or [pa.RecordBatch.from_pylist([], texts.schema)]:
            ids = batch.column("doc").fill_null(NO_ID).to_pylist()
            marks = batch.column("mark").to_pylist()
            for lo, hi, data, offsets in slabs(batch.column("text")):
                words = Words(data, offsets, SPACED)
                found = {i: by_key[k] for i in range(hi - lo) if (k := (ids[lo + i], marks[lo + i])) in by_key}
                out.append(fill(batch.slice(lo, hi - lo), words, ~_covered(words, found, size)))
            if not len(batch):
                none = Words(np.empty(0, np.uint8), np.zeros(1, np.int64), SPACED)
                out.append(fill(batch, none, np.empty(0, bool)))
        return pa.Table.from_batches(out)

    return keyed.groupBy("home").cogroup(lost.groupBy("home")).applyInArrow(strip, schema)


def _removed(words: Words, keep: np.ndarray) -> pa.Array:
    gone = np.bincount(words.text_of()[~keep], minlength=len(words.counts))
    return pa.array(gone.astype(np.int64))


def repeated_words(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``.

    A word is removed if a window of ``size`` consecutive words that covers it also starts in a document with
    a smaller id. Null and empty texts have no words. A null id counts as larger than any other. Rows with
    equal ids do not make each other lose words. Columns other than doc_id and text are ignored.
    """

    def fill(batch: pa.RecordBatch, words: Words, keep: np.ndarray) -> pa.RecordBatch:
        out, at = _kept_texts(words, keep)
        raw = out.tobytes()
        sha = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words.counts, pa.int64()), _removed(words, keep), pa.array(sha, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    return _cleaned(docs.select("doc_id", "text"), size, fill, schema)


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs`` with its columns, text without repeated words.

    A text that loses nothing stays as it is; else its kept words are joined by one blank. A document
    that loses all words stays as a row with an empty text. A column n_chars is counted anew. Columns may have any names.
    """
    counted = [n for n in ("n_chars",) if n in {c.lower() for c in docs.columns}]
    carried = Carried(docs, "doc_id", "text", *counted)
    names = carried.work.columns

    def fill(batch: pa.RecordBatch, words: Words, keep: np.ndarray) -> pa.RecordBatch:
        out, at = _kept_texts(words, keep)
        raw, old = out.tobytes(), batch.column("text").to_pylist()
        gone = _removed(words, keep).to_pylist()
        text = [
            raw[at[i] : max(at[i], at[i + 1] - 1)].decode() if n else old[i]
            for i, n in enumerate(gone)
        ]
        new = pa.array(text, batch.schema.field("text").type)
        return pa.RecordBatch.from_arrays([new if n == "text" else batch.column(n) for n in names], names=names)

    out = _cleaned(carried.work, size, fill, carried.schema())
    return carried.back(out, **{n: F.length("text").cast(carried.work.schema[n].dataType) for n in counted})
