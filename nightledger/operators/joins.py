"""Joins that need more than an equi key, shaped so that no key is handled in one piece.

No side is broadcast by hint: Spark broadcasts a side once its measured size allows it and
shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.functions.dates import DAY, slot_start
from nightledger.operators.windows import first_row
from nightledger.session import cut_lineage


def enrich(df: DataFrame, other: DataFrame, on: Sequence[str], cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Set ``cols`` from ``other`` where the key matches, else keep them.

    ``other`` is first reduced to one row per key, the smallest by ``order``.
    """
    one = other.groupBy(*on).agg(first_row(cols, order).alias("_new"))
    kept = [c for c in df.columns if c not in cols]
    joined = df.join(one, list(on), "left")
    out = [
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c) if c in df.columns else None).alias(c)
        for c in cols
    ]
    return joined.select(*kept, *out)


def with_memberships(df: DataFrame, key: str, lists: dict[str, DataFrame]) -> DataFrame:
    """Add one boolean per named key list, with a single join for all lists."""
    members = None
    for name, frame in lists.items():
        part = frame.select(F.col(key), F.lit(name).alias("_list"))
        members = part if members is None else members.unionByName(part)
    flags = members.groupBy(key).agg(*[F.max(F.col("_list") == n).alias(n) for n in lists])
    joined = df.join(flags, key, "left")
    return joined.select(*df.columns, *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in lists])


def label_by_precedence(rules: Sequence[tuple[Column, Column | int]], default: Column | int = 0) -> Column:
    """Label of the last rule that holds; later rules overwrite earlier ones."""
    expr = default if isinstance(default, Column) else F.lit(default)
    for cond, label in rules:
        expr = F.when(cond, label).otherwise(expr)
    return expr


SHORT_INTERVAL = 8


def dyadic_cover(start: Column, end: Column, slot: int) -> Column:
    """Blocks (level, block) that together are the ``slot``-wide slots touched from ``start`` to ``end``.

    A block of level j is 2^j neighbouring slots, the first a multiple of 2^j. An interval that touches few slots has
    one block for each, any other the fewest blocks there are: at most two of a level.
    """
    first = F.floor(start / slot)
    stop = F.floor(end / slot) + 1
    few = F.transform(
        F.sequence(first, stop - 1), lambda b: F.struct(F.lit(0).alias("level"), b.alias("block"))
    )

    def pair(level: Column) -> Column:
        low = -F.call_function("shiftright", -first, level)  # first whole block of the level, and the one after the last
        high = F.call_function("shiftright", stop, level)
        left = F.when((low < high) & (low % 2 != 0), F.struct(level.alias("level"), low.alias("block")))
        right = F.when((low < high) & (high % 2 != 0), F.struct(level.alias("level"), (high - 1).alias("block")))
        return F.filter(F.array(left, right), lambda x: x.isNotNull())

    levels = F.sequence(F.lit(0), F.ceil(F.log2((stop - first).cast("double"))).cast("int"))
    return F.when(stop - first <= SHORT_INTERVAL, few).otherwise(F.flatten(F.transform(levels, pair)))


CELL_ROWS = 4096  # rows of a side from which a cell is cut
TASK_PAIRS = 1 << 16  # pairs that are worth a task of their own


def _in_blocks(df: DataFrame, large: DataFrame, cell: Sequence[str], own: str, other: str) -> DataFrame:
    """Rows once for each block of their line: ``own`` is the line, from the row's hash, ``other`` runs over the blocks."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    hashed = [f"`{name}`" for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    line = F.pmod(F.xxhash64(*hashed), F.coalesce(own, one)).alias(own)
    blocks = F.explode(F.sequence(zero, F.coalesce(other, one) - 1)).alias(other)
    return df.join(large, list(cell), "left").select(*df.columns, line, blocks)


def join_cells(points: DataFrame, intervals: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Equi join on ``cell`` whose pairs, not only its rows, are dealt over the tasks.

    A cell of more than ``CELL_ROWS`` rows of a side is cut into blocks of about so many points by so many intervals. A row
    is dealt by its hash to one line of blocks and goes to each block of the line, so a point and an interval share exactly one
    block; rows equal in every column share a line. The number of partitions follows from the pairs, up to the session's,
    and is fixed: adaptive execution merges and splits by bytes, and few bytes may hold many pairs. The cells are
    counted when this is called; only if some are large do they go to the shared folder and are the rows looked up in them.
    """
    keys, points_here, spans_here = list(cell), F.col("_points"), F.col("_spans")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = points.select(*keys, one.alias("_points"), none.alias("_spans")).unionByName(
        intervals.select(*keys, none.alias("_points"), one.alias("_spans"))
    )
    sizes = rows.groupBy(*keys).agg(F.sum("_points").alias("_points"), F.sum("_spans").alias("_spans"))
    sizes = sizes.filter((points_here > 0) & (spans_here > 0))
    most = F.max(F.greatest(points_here, spans_here))
    most, pairs = sizes.agg(most, F.sum(points_here.cast("double") * spans_here)).first()  # two numbers
    if (most or 0) > CELL_ROWS:
        large = sizes.filter(F.greatest(points_here, spans_here) > CELL_ROWS)
        large = cut_lineage(
            large.select(*keys, F.ceil(points_here / CELL_ROWS).alias("_down"), F.ceil(spans_here / CELL_ROWS).alias("_across"))
        )
        points = _in_blocks(points, large, keys, "_down", "_across")
        intervals = _in_blocks(intervals, large, keys, "_across", "_down")
        keys += ["_down", "_across"]
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = int(min(tasks, (pairs or 0) // TASK_PAIRS + 1))
    return points.repartition(tasks, *keys).join(intervals.repartition(tasks, *keys), keys).drop("_down", "_across")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    time: str,
    start: str,
    end: str,
    slot: int = 3600,
) -> DataFrame:
    """Points paired with every interval of the same key that contains them, ends included.

    Intervals are cut into the blocks of :func:`dyadic_cover`, some 30 for ten years of hours, and a point is filed
    under its block of every level that occurs among the intervals: the slot alone while all are short. The join is an
    equi join on (key, level, block), so a busy key is spread over its blocks, and :func:`join_cells` cuts one that is
    still large. Each slot of an interval lies in one of its blocks, so no pair is met twice. Intervals that end
    before they start contain nothing.
    """
    cover = F.explode(dyadic_cover(F.col(start), F.col(end), slot)).alias("_piece")
    spread = intervals.filter(F.col(start) <= F.col(end)).select("*", cover)
    spread = spread.select(*intervals.columns, F.col("_piece.level").alias("_level"), F.col("_piece.block").alias("_block"))
    levels = spread.agg(F.sort_array(F.collect_set("_level"))).scalar()  # at most 64, read once
    placed = points.select("*", F.explode(levels).alias("_level"))
    block = F.call_function("shiftright", F.floor(F.col(time) / slot), F.col("_level"))
    return (
        join_cells(placed.withColumn("_block", block), spread, [*on, "_level", "_block"])
        .filter(F.col(time).between(F.col(start), F.col(end)))
        .drop("_level", "_block")
    )


def count_containing(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    time: str,
    counts: dict[str, tuple[Column, Column]],
    slot: int = DAY,
) -> DataFrame:
    """Distinct (key, second) of ``points`` with the number of intervals of the key that contain it, ends included.

    ``counts`` names one number for each pair of ends; an interval that ends before it starts or lacks an end is left out
    of it. No pairs are formed: an interval counts up at its start and down after its end, the changes are added up
    per (key, second), and running sums go over the seconds of a (key, slot), as in :func:`nearest_lookup`; what earlier slots
    leave open comes from one row per slot. So a window holds at most two rows per second of a slot.
    """
    keys, names = list(on), list(counts)
    changes = []
    for name, (start, end) in counts.items():
        valid = F.coalesce(start <= end, F.lit(False))
        for at, step in ((start, 1), (end + 1, -1)):
            steps = [F.lit(step if n == name else 0).cast("bigint").alias(n) for n in names]
            changes.append(F.when(valid, F.struct(at.cast("bigint").alias("_t"), *steps)))
    moves = intervals.select(*keys, F.explode(F.array(*changes)).alias("_move")).filter(F.col("_move").isNotNull())
    moves = moves.select(*keys, "_move.*").groupBy(*keys, "_t").agg(*[F.sum(n).alias(n) for n in names])
    asks = points.select(*keys, F.col(time).cast("bigint").alias("_t")).filter(F.col("_t").isNotNull()).distinct()
    marks = moves.withColumn("_turn", F.lit(0)).unionByName(asks.withColumn("_turn", F.lit(1)), allowMissingColumns=True)
    marks = marks.withColumn("_slot", slot_start(F.col("_t"), slot))
    inside = Window.partitionBy(*keys, "_slot").orderBy("_t", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    here = marks.select(*keys, "_slot", "_t", "_turn", *[F.sum(n).over(inside).alias(n) for n in names])
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = marks.groupBy(*keys, "_slot").agg(*[F.sum(n).alias(n) for n in names])
    slots = slots.select(*keys, "_slot", *[F.sum(n).over(earlier).alias(f"_open_{n}") for n in names])
    zero = F.lit(0)
    return (
        here.filter(F.col("_turn") == 1)
        .join(slots, [*keys, "_slot"])
        .select(
            *keys,
            F.col("_t").alias(time),
            *[(F.coalesce(n, zero) + F.coalesce(f"_open_{n}", zero)).alias(n) for n in names],
        )
    )


STRETCH = 3  # widths of a cell that an interval may be long


def start_cell(start: Column, end: Column, slot: int = 3600) -> tuple[Column, Column]:
    """The one cell (level, block) of an interval: the block its start lies in, of the smallest level that suits its length.

    A block of level j is 2^j slots wide, and an interval at most ``STRETCH`` blocks long.
    """
    widths = F.ceil((end - start) / (STRETCH * slot))
    level = F.when(widths <= 1, 0).otherwise(F.length(F.bin(widths - 1)))
    return level, F.call_function("shiftright", F.floor(start / slot), level)


def stretch_cells(points: DataFrame, time: Column, cells: DataFrame, level: str, block: str, slot: int = 3600) -> DataFrame:
    """Points once for every cell whose intervals may contain them, see :func:`start_cell`: ``STRETCH`` + 1 of each level in ``cells``.

    An interval meets all points that it contains in its own cell, so what is gathered by cell is whole.
    """
    levels = cells.agg(F.sort_array(F.collect_set(level))).scalar()  # at most 64, read once
    own = F.call_function("shiftright", F.floor(time / slot), F.col(level))
    return points.select("*", F.explode(levels).alias(level)).select(
        "*", F.explode(F.sequence(own - STRETCH, own)).alias(block)
    )


@dataclass(frozen=True)
class Lookup:
    """What to find for an asked second: the nearest row of ``rows`` with the same key.

    ``direction`` is ``backward`` (at or before), ``forward`` (at or after) or ``nearest``
    (the earlier one on equal distance); ``strict`` excludes equal times and ``tolerance``
    bounds the distance. Rows of the same second are reduced to the smallest by ``order``. ``where`` leaves rows out;
    lookups in the same frame are reduced in one pass over it.
    """

    name: str
    rows: DataFrame
    time: str
    cols: Sequence[str]
    order: Sequence[str]
    direction: str = "backward"
    tolerance: int | None = None
    strict: bool = False
    where: Column | None = None

    def source(self) -> tuple:
        """Lookups with equal sources share their rows."""
        return id(self.rows), self.time, self.strict

    def ways(self) -> list[str]:
        return {"backward": ["before"], "forward": ["after"], "nearest": ["before", "after"]}[self.direction]

    def reduced(self) -> Column:
        """Aggregate: the smallest row that counts, in the shape of :func:`first_row`."""
        row = F.struct(*[F.col(c).alias(f"_by_{c}") for c in self.order], *self.cols)
        return F.min(row if self.where is None else F.when(self.where, row))

    def found(self, value: Column) -> Column:
        row = F.struct(F.col("_t").alias("matched_time"), *[value[c].alias(c) for c in self.cols])
        return F.when(value.isNotNull(), row)

    def pick(self, before: Column | None, after: Column | None) -> Column:
        if before is None or after is None:
            hit = after if before is None else before
        else:
            closer = (after.getField("matched_time") - F.col("_t")) < (F.col("_t") - before.getField("matched_time"))
            hit = F.when(before.isNull() | closer, after).otherwise(before)
        if self.tolerance is None:
            return hit
        return F.when(F.abs(hit.getField("matched_time") - F.col("_t")) <= self.tolerance, hit)


def _by_source(lookups: Sequence[Lookup]) -> list[list[Lookup]]:
    groups: dict[tuple, list[Lookup]] = {}
    for lookup in lookups:
        groups.setdefault(lookup.source(), []).append(lookup)
    return list(groups.values())


def _per_second(lookups: Sequence[Lookup], keys: Sequence[str]) -> DataFrame:
    """One row per (key, second) of a frame with what each lookup in it finds there."""
    first = lookups[0]
    second = F.col(first.time).cast("bigint").alias("_t")
    some = [F.lit(True) if x.where is None else F.coalesce(x.where, F.lit(False)) for x in lookups]
    rows = first.rows.filter(reduce(lambda a, b: a | b, some))
    found = rows.groupBy(*keys, second).agg(*[x.reduced().alias(f"_v_{x.name}") for x in lookups])
    # Strict rows sort after the asking row of their second and so are not seen by it.
    turn = F.lit(2 if first.strict else 0).alias("_turn")
    return found.select(*keys, "_t", turn, *[x.found(F.col(f"_v_{x.name}")).alias(x.name) for x in lookups])


def nearest_lookup(
    asks: DataFrame, on: Sequence[str], time: str, lookups: Sequence[Lookup], slot: int | None = DAY
) -> DataFrame:
    """Distinct (key, second) asked for, with one struct per lookup: ``matched_time`` and its columns, or NULL.

    All sides are first reduced to one row per (key, second), and the windows run within
    (key, slot) only; what a slot inherits from its neighbours comes from one row per slot.
    So a window holds at most one row per second of a slot and side however many rows a key
    has, and no pairs are formed. Where ``on`` already holds the day, ``slot`` is None: a key
    then spans one day and nothing is inherited.
    """
    keys = list(on)
    marks = asks.select(*keys, F.col(time).cast("bigint").alias("_t")).distinct().withColumn("_turn", F.lit(1))
    for same in _by_source(lookups):
        marks = marks.unionByName(_per_second(same, keys), allowMissingColumns=True)
    if slot is not None:
        marks = marks.withColumn("_slot", slot_start(F.col("_t"), slot))
    part = keys if slot is None else [*keys, "_slot"]
    inside = Window.partitionBy(*part)
    order = {"before": F.col("_t").asc(), "after": F.col("_t").desc()}
    running = {}
    for lookup in lookups:
        for way in lookup.ways():
            frame = inside.orderBy(order[way], "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
            running[f"_{way}_{lookup.name}"] = F.last(lookup.name, ignorenulls=True).over(frame)
    found = marks.select(*part, *([] if "_t" in part else ["_t"]), "_turn", *[c.alias(n) for n, c in running.items()])
    found = found.filter(F.col("_turn") == 1)
    if slot is not None:
        found = found.join(_slot_edges(marks, keys, lookups), part)

    def seen(lookup: Lookup, way: str) -> Column | None:
        if way not in lookup.ways():
            return None
        here = F.col(f"_{way}_{lookup.name}")
        return here if slot is None else F.coalesce(here, F.col(f"_carry_{way}_{lookup.name}"))

    return found.select(
        *keys,
        F.col("_t").alias(time),
        *[lookup.pick(seen(lookup, "before"), seen(lookup, "after")).alias(lookup.name) for lookup in lookups],
    )


def _slot_edges(marks: DataFrame, keys: list[str], lookups: Sequence[Lookup]) -> DataFrame:
    """Per (key, slot), the nearest row of each lookup in an earlier and in a later slot."""
    by_slot = Window.partitionBy(*keys).orderBy("_slot")
    earlier = by_slot.rowsBetween(Window.unboundedPreceding, -1)
    later = by_slot.rowsBetween(1, Window.unboundedFollowing)
    edges, carries = [], []
    for lookup in lookups:
        own = F.when(F.col(lookup.name).isNotNull(), F.col("_t"))
        for way in lookup.ways():
            name = f"_{way}_{lookup.name}"
            before = way == "before"
            edges.append((F.max_by if before else F.min_by)(lookup.name, own).alias(name))
            carry = F.last(name, True).over(earlier) if before else F.first(name, True).over(later)
            carries.append(carry.alias(f"_carry{name}"))
    return marks.groupBy(*keys, "_slot").agg(*edges).select(*keys, "_slot", *carries)


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    cols: Sequence[str],
    order: Sequence[str],
    direction: str = "backward",
    tolerance: int | None = None,
    strict: bool = False,
    slot: int | None = DAY,
) -> DataFrame:
    """Each left row with ``matched_time`` and ``cols`` of the nearest right row of its key, or NULLs.

    See :class:`Lookup` for the rules and :func:`nearest_lookup` for how it scales.
    """
    lookup = Lookup("_hit", right, right_time, cols, order, direction, tolerance, strict)
    found = nearest_lookup(left, on, left_time, [lookup], slot)
    return left.join(found, [*on, left_time], "left").select(
        *left.columns, "_hit.matched_time", *[f"_hit.{c}" for c in cols]
    )


def within_window_after(
    first: DataFrame, later: DataFrame, on: Sequence[str], first_time: str, later_time: str, low: int, high: int
) -> DataFrame:
    """Later rows of the same key that fall ``low`` to ``high`` seconds after the key's first time.

    ``first`` has one row per key, so every later row meets at most one partner.
    """
    return first.join(later, list(on)).filter(
        F.col(later_time).between(F.col(first_time) + low, F.col(first_time) + high)
    )


PIECE = 8  # characters of an inner piece that are filed


def _filed(pattern: Column) -> Column:
    """Shape (kind, length) and piece under which a LIKE pattern is filed: a literal text it requires.

    The text before the first wildcard (``p``), else the text after the last one (``s``), else the start of its longest
    inner piece (``i``), which is empty for a pattern of wildcards only.
    """
    before = F.regexp_extract(pattern, r"^[^%_\\]*", 0)
    after = F.regexp_extract(pattern, r"[^%_\\]*$", 0)
    inner = F.array_max(
        F.transform(F.split(pattern, r"[%_\\]"), lambda x: F.struct(F.length(x).alias("n"), x.alias("piece")))
    )

    def shape(kind: str, piece: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.length(piece).alias("length"), piece.alias("piece"))

    return (
        F.when(before != "", shape("p", before))
        .when(after != "", shape("s", after))
        .otherwise(shape("i", F.substring(inner["piece"], 1, PIECE)))
    )


def _pieces(value: Column, shape: Column) -> Column:
    """Hashes of the pieces of a value that have the shape: one of a prefix or suffix, all different inner ones."""
    n, kind, size = F.length(value), shape["kind"], shape["length"]
    starts = (
        F.when(size > n, F.array().cast("array<int>"))
        .when(kind == "p", F.array(F.lit(1)))
        .when((kind == "s") | (size == 0), F.array(n - size + 1))
        .otherwise(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))))
    )
    return F.array_distinct(F.transform(starts, lambda at: F.xxhash64(kind, F.substring(value, at, size))))


def match_patterns(values: DataFrame, patterns: DataFrame, value: str, pattern: str) -> DataFrame:
    """Distinct values paired with every LIKE pattern they match, without comparing all with all.

    A pattern is filed under a literal piece it requires, see :func:`_filed`. Only the shapes that occur among the
    patterns are cut from a value: one prefix or suffix for each length, and all places for inner pieces, so a value of n
    characters has at most n keys for each inner length and one for every other shape. Pieces are joined as
    hashes and the LIKE test runs on the pairs that meet, so hashes that coincide do no harm. NULL matches nothing.
    """
    pat, val = F.col(pattern), F.col(value)
    filed = patterns.filter(pat.isNotNull()).withColumn("_filed", _filed(pat))
    shapes = filed.agg(F.collect_set(F.struct("_filed.kind", "_filed.length"))).scalar()  # as many as pattern lengths
    filed = filed.withColumn("_key", F.xxhash64("_filed.kind", "_filed.piece")).drop("_filed")
    return (
        values.select(value)
        .filter(val.isNotNull())
        .distinct()
        .select(value, F.explode(shapes).alias("_shape"))
        .select(value, F.explode(_pieces(val, F.col("_shape"))).alias("_key"))
        .join(filed, "_key")
        .filter(F.like(val, pat))
        .drop("_key")
    )


def pattern_join(df: DataFrame, patterns: DataFrame, value: str, pattern: str) -> DataFrame:
    """Rows paired with every LIKE pattern their value matches."""
    return df.join(match_patterns(df, patterns, value, pattern), value)


def best_pattern(
    values: DataFrame, patterns: DataFrame, value: str, pattern: str, cols: Sequence[str], rank: Column, tie: str
) -> DataFrame:
    """Distinct values with ``cols`` of their best matching pattern.

    Highest ``rank`` wins, then the longer pattern, then the smaller ``tie``.
    """
    order = F.struct(rank, F.length(pattern), -F.col(tie))
    return (
        match_patterns(values, patterns, value, pattern)
        .groupBy(value)
        .agg(F.max_by(F.struct(*cols), order).alias("_best"))
        .select(value, *[F.col(f"_best.{c}").alias(c) for c in cols])
    )
