"""Approximate nearest neighbours by largest inner product over balanced posting lists.

Vectors get one more component that makes all norms equal, so the largest inner product is the smallest distance.
A bounded sample is halved again and again along its main direction into balanced clusters. Every vector joins the
list of its nearest centroid, and those at the boundary join further lists. Centroids are searched through
a neighbour graph in memory; a query visits the lists whose distance is within a ratio of the nearest. The ratio is
learnt on the sample, so that it covers ``COVER`` of true neighbours there. The nearest few lists are searched first; what
they give is the bar for the others.

Equal vectors are one entry with their smallest ids, as many as an answer can show: no list grows with
copies. A list of many vectors or queries is cut into blocks that meet in pairs, each in a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from nightledger.llm.frames import cut_lineage

SAMPLE, SAMPLE_BYTES = 40_000, 64 << 20  # vectors that fit the index, as doubles
LIST_SIZE, MAX_LISTS = 1024, SAMPLE // 8
REPLICAS, BOUNDARY = 4, 1.10
DEGREE, TRIALS, COVER = 16, 256, 0.98
BLOCK = 8192
FIRST_LISTS = 3  # searched first; the other lists only give what is better


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (rows**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2 * rows @ points.T
    return np.sqrt(np.maximum(square, 0))


def _balanced(rows: np.ndarray, lists: int) -> np.ndarray:
    """Centroids of about ``lists`` clusters of equal size."""
    todo, out = [(rows, lists)], []
    while todo:
        part, k = todo.pop()
        if k <= 1 or len(part) < 2:
            out.append(part.mean(0))
            continue
        centred = part - part.mean(0)
        way = centred[np.argmax((centred**2).sum(1))] + 1e-12
        for _ in range(8):
            way = centred.T @ (centred @ way)
            way /= max(np.linalg.norm(way), 1e-30)
        order = np.argsort(centred @ way, kind="stable")
        cut = len(part) * (k // 2) // k
        todo += [(part[order[:cut]], k // 2), (part[order[cut:]], k - k // 2)]
    return np.stack(out)


class Index:
    """Centroids, their neighbour graph and the ratio that selects lists."""

    def __init__(self, sample: np.ndarray, count: int, norm: float, scale: float = 1.0):
        self.norm, self.scale = norm, scale  # norm in units of scale, a power of two
        lists = int(np.clip(-(-count // LIST_SIZE), 1, max(1, min(MAX_LISTS, len(sample) // 8))))
        rows = self.lifted(sample)
        self.centroids = _balanced(rows, lists)
        between = _distances(self.centroids, self.centroids)
        self.graph = np.argsort(between, 1, kind="stable")[:, 1 : DEGREE + 1]
        # every centroid is reached: a ring through all of them, besides the near ones
        ring = (np.arange(lists) + 1) % lists
        self.graph = np.concatenate([self.graph, ring[:, None]], 1)
        self.ratio = 1.0
        if len(rows) > 1:
            trial = np.arange(0, len(rows), max(1, len(rows) // TRIALS))
            to = _distances(self.pointed(sample[trial]), self.centroids)
            needed, near = [], min(20, len(rows) - 1)
            for i, own in enumerate(trial):
                scores = (sample / scale) @ (sample[own] / scale)
                scores[own] = -np.inf
                where, row = self.lists(rows[np.argpartition(-scores, near - 1)[:near]])
                best = np.full(near, np.inf)
                np.minimum.at(best, row, to[i][where])
                needed.append(best / max(to[i].min(), 1e-12))
            self.ratio = float(np.quantile(np.concatenate(needed), COVER)) + 1e-9

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        """Stored vectors at the common norm."""
        rows = rows / self.scale
        rest = np.sqrt(np.maximum(self.norm**2 - (rows**2).sum(1), 0))
        return np.concatenate([rows, rest[:, None]], 1)

    def pointed(self, rows: np.ndarray) -> np.ndarray:
        """Query vectors at the common norm."""
        rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(1))[1][:, None])  # squares neither overflow nor vanish
        long = rows * (self.norm / np.linalg.norm(rows, axis=1))[:, None]
        return np.concatenate([long, np.zeros((len(rows), 1))], 1)

    def search(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids of each row and their distances, nearest first, by a walk of the graph."""
        k = len(self.centroids)
        width = min(width, k)
        seeds = np.unique(np.linspace(0, k - 1, min(k, max(8, width))).astype(np.int64))
        seen = np.zeros((len(rows), k), bool)
        seen[:, seeds] = True
        ids = np.tile(seeds, (len(rows), 1))
        far = _distances(rows, self.centroids[seeds])
        done = np.zeros(ids.shape, bool)
        while True:
            order = np.argsort(far, 1, kind="stable")[:, :width]
            ids, far, done = (np.take_along_axis(x, order, 1) for x in (ids, far, done))
            open_ = ~done & np.isfinite(far)
            if not open_.any():
                return ids, far
            at = open_.argmax(1)
            line = np.arange(len(rows))
            active = open_[line, at]
            done[line[active], at[active]] = True
            next_ = self.graph[ids[line, at]]
            new = ~seen[line[:, None], next_] & active[:, None]
            seen[np.broadcast_to(line[:, None], next_.shape)[new], next_[new]] = True
            step = np.full(next_.shape, np.inf)
            if new.any():
                i = np.broadcast_to(line[:, None], next_.shape)[new]
                step[new] = np.sqrt(((rows[i] - self.centroids[next_[new]]) ** 2).sum(1))
            ids, far = np.concatenate([ids, next_], 1), np.concatenate([far, step], 1)
            done = np.concatenate([done, ~new], 1)

    def lists(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lists of stored vectors and the row each belongs to; a boundary vector has several."""
        ids, far = self.search(lifted, 2 * REPLICAS)
        chosen = [np.zeros((len(ids), 0), np.int64), np.zeros((len(ids), 0), bool)]
        for j in range(ids.shape[1]):
            ok = far[:, j] <= BOUNDARY * far[:, 0] + 1e-12
            for i in range(j):  # not towards a centroid that a chosen one is nearer to
                gap = np.sqrt(((self.centroids[ids[:, j]] - self.centroids[ids[:, i]]) ** 2).sum(1))
                ok &= ~(chosen[1][:, i] & (gap < far[:, j]))
            ok &= chosen[1].sum(1) < REPLICAS
            if j == 0:
                ok[:] = True
            chosen = [np.concatenate([chosen[0], ids[:, j : j + 1]], 1), np.concatenate([chosen[1], ok[:, None]], 1)]
        row, place = np.nonzero(chosen[1])
        return ids[row, place], row

    def visits(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists that queries visit, the row each belongs to, and whether it is among the row's nearest."""
        width, points = 64, self.pointed(rows)
        while True:
            ids, far = self.search(points, width)
            if width >= len(self.centroids) or (far[:, -1] > self.ratio * far[:, 0]).all():
                break
            width *= 2
        row, place = np.nonzero(far <= self.ratio * far[:, :1])
        return ids[row, place], row, place < FIRST_LISTS


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part; float components stay float, others are double.

    Vectors that are null, zero, hold null or non-finite components, have no id, or are not of the commonest length
    do not.
    """
    own = vectors.schema["embedding"].dataType
    kind = "float" if isinstance(own, ArrayType) and isinstance(own.elementType, FloatType) else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("embedding", lambda x: x != 0))
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == (length.n if length else 0))


def nearest(vectors: DataFrame, every: int = 20, count: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the ``count`` nearest found of each query.

    Queries are the rows whose vec_id is divisible by ``every``; the candidates of one are all rows with another vec_id.
    The score is the inner product of the given components in double precision, infinite beyond its range; ties go to the smaller vec_id. If there are fewer candidates,
    all are returned; a query whose lists hold fewer than ``count`` visits all lists. Rows that take no part are those of ``usable``; repeated rows are one.
    """
    rows = usable(vectors)
    own = Window.partitionBy("embedding").orderBy("vec_id")
    entries = rows.withColumn("place", F.dense_rank().over(own)).where(F.col("place") <= count + 1)
    entries = entries.groupBy("embedding").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
    entries = cut_lineage(entries)
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    size = F.first(F.size("embedding"))
    total, most, length, names = entries.agg(F.count("*"), F.max(largest), size, F.sum(F.size("ids"))).first()
    kind = rows.schema["embedding"].dataType.simpleString()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return vectors.sparkSession.createDataFrame([], schema)
    fitting = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * length)))
    sample = entries.select("embedding").orderBy(F.xxhash64("embedding"), "embedding").limit(fitting).toArrow()
    scale = math.ldexp(0.5, math.frexp(most)[1])
    parts = F.transform("embedding", lambda x: x.cast("double") / F.lit(scale))
    (square,) = entries.agg(F.max(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x * x))).first()
    index = Index(_matrix(sample.column(0).combine_chunks()), total, float(np.sqrt(square)) * (1 + 1e-9), scale)
    shared = vectors.sparkSession.sparkContext.broadcast(index)  # MAX_LISTS centroids at most

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        for batch in batches:
            for lo in range(0, len(batch), 512):
                part = batch.slice(lo, 512)
                yield part, _matrix(part.column("embedding"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, matrix in parts_of(batches):
            lists, row = shared.value.lists(shared.value.lifted(matrix))
            found = [pa.array(lists, pa.int32()), *(part.column(c).take(pa.array(row)) for c in ("embedding", "ids"))]
            yield pa.RecordBatch.from_arrays(found, names=["list", "embedding", "ids"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, matrix in parts_of(batches):
            lists, row, near = shared.value.visits(matrix)
            found = [pa.array(lists, pa.int32()), *(part.column(c).take(pa.array(row)) for c in ("embedding", "vec_id"))]
            yield pa.RecordBatch.from_arrays([*found, pa.array(near)], names=["list", "embedding", "vec_id", "near"])

    stored = cut_lineage(entries.mapInArrow(store, f"list int, embedding {kind}, ids array<long>"))
    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    asked = cut_lineage(queries.mapInArrow(ask, f"list int, embedding {kind}, vec_id long, near boolean"))
    sizes = stored.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))  # a row per list

    def compare(points: pa.Table, queries: pa.Table) -> pa.Table:
        found, scored, asker = [], [], []
        if len(points) and len(queries):
            points, queries = points.combine_chunks(), queries.combine_chunks()
            stored_rows, ids = _matrix(points.column("embedding").chunk(0)), points.column("ids").to_pylist()
            query_rows, names = _matrix(queries.column("embedding").chunk(0)), queries.column("vec_id").to_pylist()
            floor = queries.column("floor").to_numpy()
            for lo in range(0, len(query_rows), 256):
                rough = query_rows[lo : lo + 256] @ stored_rows.T
                keep = min(count + 1, rough.shape[1])  # one entry may hold the query alone
                least = np.maximum(np.partition(rough, -keep, 1)[:, -keep], floor[lo : lo + 256])
                for i, row in enumerate(rough):
                    near = np.flatnonzero(~(row < least[i] - 1e-9 * (1 + np.abs(row).max())))
                    exact = (query_rows[lo + i] * stored_rows[near]).sum(1)
                    pairs = [(-s, v) for s, j in zip(exact, near, strict=True) for v in ids[j] if v != names[lo + i]]
                    for s, v in sorted(pairs)[:count]:
                        asker.append(names[lo + i])
                        found.append(v)
                        scored.append(-s)
        kinds = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        return pa.table({n: pa.array(v, kinds[n]) for n, v in zip(kinds, (asker, found, scored), strict=True)})

    def searched(queries: DataFrame) -> DataFrame:
        """The best of each visited list, of the lists cut into blocks the best of each block."""
        asks = queries.groupBy("list").agg(F.ceil(F.count("*") / BLOCK).alias("turns"))
        plan = F.broadcast(sizes.join(asks, "list"))  # a row per list, MAX_LISTS at most
        part = F.pmod(F.xxhash64("embedding"), F.col("parts")).cast("int").alias("part")
        turn = F.pmod(F.xxhash64("vec_id"), F.col("turns")).cast("int").alias("turn")
        turns = F.explode(F.sequence(F.lit(0), F.col("turns").cast("int") - 1)).alias("turn")
        parts = F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)).alias("part")
        left = stored.join(plan, "list").select("list", part, "embedding", "ids", turns)
        right = queries.join(plan, "list").select("list", turn, "embedding", "vec_id", "floor", parts)
        key = ["list", "part", "turn"]
        pairs = left.groupBy(*key).cogroup(right.groupBy(*key))
        return pairs.applyInArrow(compare, "query_id long, vec_id long, score double")

    first = cut_lineage(searched(asked.where("near").withColumn("floor", F.lit(float("-inf")))))
    floors = first.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = floors.withColumn("place", F.row_number().over(best)).where(F.col("place") == count)
    floors = floors.select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
    later = asked.where("not near").join(floors, "vec_id", "left")
    pairs = first.union(searched(later.withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))))

    def ranked(pairs: DataFrame) -> DataFrame:
        pairs = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        out = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
        return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    found = cut_lineage(ranked(pairs))
    full = found.groupBy("query_id").count().where(F.col("count") >= min(count, names - 1))
    short = cut_lineage(queries.join(full.select(F.col("query_id").alias("vec_id")), "vec_id", "left_anti"))
    if short.isEmpty():
        return found
    every_list = F.explode(F.sequence(F.lit(0), F.lit(len(index.centroids) - 1)))
    wide = short.withColumns({"floor": F.lit(float("-inf")), "list": every_list})
    return found.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").union(
        ranked(searched(wide)).select("query_id", "rank", "vec_id", "score")
    )
