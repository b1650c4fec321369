"""Mixing sources to target weights by pivotal dependent rounding, on DataFrame functions only.

Every document of a source has the same fractional number of copies, target over source size. Its whole part is
taken; the fraction is rounded so that the words of the source stay as they are: of two documents with
open fractions, one hands words to the other until one of them is at none or all, in a random direction that leaves
both expectations unchanged. Documents meet in groups of about ``GROUP``; each group leaves one open document
at most, the open ones of ``GROUP`` groups meet again, and so on up a tree. The one document left open at the top of a source goes to
the nearer side, so the words taken of a source differ from its target by half a document at most.

All randomness is a hash of the seed and the document, so a rerun takes the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nightledger.llm.frames import Carried, cut_lineage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
GROUP = 64
PORTION = 4096  # rows of one class that a row of its portions stands for
SEED = 20240601
WORD, BLANKS = r"[^\x20\x09-\x0D]+", " \t\n\x0b\x0c\r"


def word_count(text: Column) -> Column:
    """Number of words, without an array of them; null has none."""
    marks = F.translate(F.regexp_replace(text, WORD, "x"), BLANKS, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def _uniform(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / F.lit(float(1 << 53))


def source_targets(sized: DataFrame) -> DataFrame:
    """source, rank, source_size, n and target of every source in ``sized`` (source, size, rows).

    ``rows`` counts equal rows; ``n`` is the number of different ones.

    Sources in order of code points, null last, get the weights in turn. What a source cannot take beyond ``MOST``
    times its size is shared again among the others, until the level that all the others get by weight is fixed.
    """
    totals = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("n"))
    placed = totals.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    placed = cut_lineage(placed.withColumn("part", F.shiftright("at", 33)))
    parts = placed.groupBy("part").agg(F.count("*").alias("rows"))  # one row per task of the sort
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))
    rank = F.col("before") + F.col("at") - F.shiftleft("part", 33)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = placed.join(parts, "part").withColumn("rank", rank).withColumn("weight", weight)

    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > MOST * F.col("source_size")
        held, number, weights = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("source_size"))), F.lit(0)),
            F.count(F.when(over, 1)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if number == full or not weights:
            break
        level, full = (SHARE * total - MOST * held) / weights, number
    target = F.least(F.col("weight") * F.lit(level), MOST * F.col("source_size")).cast("double")
    return ranked.select("source", "rank", "source_size", "n", target.alias("target"))


def _open(mass: Column, size: Column) -> Column:
    return (mass > 0) & (mass < size)


def _pair(items: Column) -> Column:
    """Round a list of (u, id, size, mass): those decided with their ``take``, and the one left open."""

    def take(item: Column) -> Column:
        return F.struct(item.id.alias("id"), (item.mass > 0).alias("take"))

    def held(item: Column, mass: Column) -> Column:
        return F.struct(item.u.alias("u"), item.id.alias("id"), item.size.alias("size"), mass.alias("mass"))

    def step(state: Column, new: Column) -> Column:
        old = state.last
        gain, give = F.least(old.size - old.mass, new.mass), F.least(old.mass, new.size - new.mass)
        up = new.u * (gain + give) < give
        both = old.mass + new.mass
        # words go from new to old, or from old to new; the one that reaches its bound gets exactly that
        up_old = F.when(old.size - old.mass <= new.mass, old.size).otherwise(both)
        up_new = F.when(old.size - old.mass <= new.mass, both - old.size).otherwise(F.lit(0.0))
        down_new = F.when(new.size - new.mass <= old.mass, new.size).otherwise(both)
        down_old = F.when(new.size - new.mass <= old.mass, both - new.size).otherwise(F.lit(0.0))
        moved = F.array(
            held(old, F.when(up, up_old).otherwise(down_old)), held(new, F.when(up, up_new).otherwise(down_new))
        )
        moved = F.when(_open(old.mass, old.size), moved).otherwise(F.array(old, new))

        def settle(pair: Column) -> Column:
            first, second = pair[0], pair[1]
            stays = ~_open(second.mass, second.size) & _open(old.mass, old.size)
            done, last = F.when(stays, second).otherwise(first), F.when(stays, first).otherwise(second)
            return F.struct(F.concat(state.done, F.array(take(done))).alias("done"), last.alias("last"))

        return F.transform(F.array(moved), settle)[0]

    first = items[0]
    none = F.filter(F.array(take(first)), lambda _: F.lit(False))
    start = F.struct(none.alias("done"), first.alias("last"))

    def finish(state: Column) -> Column:
        last = state.last
        open_ = _open(last.mass, last.size)
        done = F.when(open_, state.done).otherwise(F.concat(state.done, F.array(take(last))))
        return F.struct(done.alias("done"), F.when(open_, last).alias("last"))

    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, step, finish)


def _decided(items: DataFrame, nodes: int) -> DataFrame:
    """id, take of every row of ``items`` (rank, node, id, size, mass); nodes of a rank are below ``nodes``."""
    item = F.struct(
        _uniform(F.col("rank"), F.col("node"), F.lit(nodes), F.hash("id")).alias("u"),
        "id",
        F.col("size").cast("double").alias("size"),
        F.col("mass").cast("double").alias("mass"),
    )
    grouped = items.groupBy("rank", "node").agg(F.array_sort(F.collect_list(item)).alias("items"))
    grouped = cut_lineage(grouped.select("rank", "node", _pair(F.col("items")).alias("out")).select("rank", "node", "out.*"))
    done = grouped.select("rank", F.explode("done").alias("d")).select("rank", "d.id", "d.take")
    left = grouped.where("last is not null").select("rank", "node", "last.*")
    if nodes == 1:
        top = left.withColumn("take", 2 * F.col("mass") >= F.col("size"))
        return done.union(top.select("rank", "id", "take"))
    up = left.select("rank", F.expr(f"node div {GROUP}").alias("node"), F.col("node").alias("id"), "size", "mass")
    above = _decided(up, -(-nodes // GROUP)).withColumnRenamed("id", "node")
    return done.union(left.join(above, ["rank", "node"]).select("rank", "id", "take"))


def _keyed(carried: Carried) -> DataFrame:
    """The rows with two hashes of all their columns, and of which of them are null."""
    row = carried.work.schema["row"].dataType
    columns = [F.col(c) for c in ("doc_id", "text", "source")] + [F.col("row")[n] for n in row.names]
    nulls = F.array(*[c.isNull() for c in columns])
    return carried.work.withColumns({f"key{i}": F.xxhash64(F.lit(i), nulls, *columns) for i in (1, 2)})


def _rounded(keyed: DataFrame) -> DataFrame:
    """doc_id, key1, key2, size, source_size, target, rows, whole and extra of every class of equal rows.

    ``whole`` copies are taken of each row and one more of ``extra`` of them. Equal rows that meet hand words to
    each other until at most one of them is open, whatever the order, so a class is rounded by arithmetic
    and only the rest of its mass is paired with other documents, as one row.
    """
    size = word_count(F.col("text")).alias("size")
    sized = keyed.select("doc_id", "source", size, "key1", "key2")
    classes = cut_lineage(sized.groupBy("doc_id", "source", "size", "key1", "key2").agg(F.count("*").alias("rows")))
    targets = cut_lineage(source_targets(classes))
    rated = classes.join(targets, classes["source"].eqNullSafe(targets["source"])).drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rated = rated.withColumn("rate", rate).withColumn("whole", F.floor("rate"))
    open_rows = (F.col("rate") - F.col("whole")) * F.col("rows")
    rated = rated.withColumn("extra", F.when(F.col("size") > 0, F.floor(open_rows)).otherwise(F.lit(0)).cast("long"))
    rated = rated.withColumn("mass", F.when(F.col("size") > 0, (open_rows - F.col("extra")) * F.col("size")).otherwise(0.0))
    most = targets.agg(F.max("n")).first()[0] or 0
    nodes = max(1, -(-most // GROUP))
    groups = F.ceil(F.col("n") / GROUP)
    columns = ["doc_id", "key1", "key2", "size", "source_size", "target", "rows", "whole", "extra"]
    open_ = rated.where("mass > 0").select(
        "rank",
        F.pmod(F.xxhash64("doc_id", "key1", F.lit(SEED)), groups).alias("node"),
        F.struct(*columns).alias("id"),
        "size",
        "mass",
    )
    taken = _decided(open_, nodes).select("id.*", "take")
    taken = taken.withColumn("extra", F.col("extra") + F.col("take").cast("long")).drop("take")
    return taken.unionByName(rated.where("mass <= 0").select(*columns))


def _each(classes: DataFrame, many: bool) -> DataFrame:
    """A row for every row of the classes, with its ``copies``; a large class is dealt over tasks in portions."""
    portion = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / PORTION)))
    dealt = classes.withColumn("portion", portion)
    dealt = dealt.hint("rebalance") if many else dealt
    first = F.col("portion") * PORTION + 1
    nth = F.explode(F.sequence(first, F.least(first + (PORTION - 1), F.col("rows"))))
    out = dealt.withColumn("nth", nth).drop("portion")
    return out.withColumn("copies", F.col("whole") + (F.col("nth") <= F.col("extra")).cast("long")).drop("nth")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and key of every row of ``docs``.

    Size is the number of words, 0 for null and empty texts, which are taken whole or not at all without effect.
    ``target`` is the document's source's share of the mix in words; ``copies`` is 0, 1 or 2 and ``taken`` is
    copies times size. A null source is a source. A null id counts like any id. Rows that agree in every column are
    one class, of which some rows are taken once more than the others; no task holds a class as rows. Columns other
    than doc_id, text and source, whatever they are called, only enter the key.
    """
    classes = cut_lineage(_rounded(_keyed(Carried(docs, "doc_id", "text", "source"))))
    out = _each(classes, _many(classes))
    taken = F.col("copies") * F.col("size")
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies", F.col("key1").alias("key"))


def _many(classes: DataFrame) -> bool:
    return (classes.agg(F.max("rows")).first()[0] or 0) > PORTION


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents that the mix takes, with their columns, ``copies`` and ``taken``; columns of these names are replaced."""
    carried = Carried(docs, "doc_id", "text", "source", without=("copies", "taken"))
    keyed = _keyed(carried)
    classes = cut_lineage(_rounded(keyed)).select("key1", "key2", "size", "rows", "whole", "extra")
    keys, columns = ["key1", "key2"], keyed.columns
    single = keyed.join(classes.where("rows = 1"), keys)
    single = single.withColumn("copies", F.col("whole") + F.col("extra"))
    row = F.first(F.struct(*[c for c in columns if c not in keys])).alias("one")  # equal rows: any of them
    repeated = keyed.join(classes.where("rows > 1"), keys).groupBy(*keys, "size", "rows", "whole", "extra").agg(row)
    repeated = _each(repeated, _many(classes)).select("one.*", *keys, "size", "rows", "whole", "extra", "copies")
    chosen = single.unionByName(repeated).where("copies > 0")
    return carried.back(chosen, {"copies": F.col("copies"), "taken": F.col("copies") * F.col("size")})
