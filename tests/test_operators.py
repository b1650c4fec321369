"""Operators against brute force on small frames, most of them with one dominant key."""

import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from nightledger.operators import aggs, joins, merge, windows


def hot(n, seed, keys=5):
    """Keys of which one holds about half of all rows."""
    rng = random.Random(seed)
    return [0 if rng.random() < 0.5 else rng.randrange(1, keys) for _ in range(n)], rng


# Order-dependent logic ------------------------------------------------------------------


@pytest.mark.parametrize("cap", [1, 7, 70])
def test_gap_dwell_equals_row_by_row(spark, rows, cap):
    keys, rng = hot(400, 1)
    beats = [(k, rng.randrange(0, 2000), i, f"d{i}") for i, k in enumerate(keys)]
    df = spark.createDataFrame(beats, "k int, t bigint, id int, dev string")
    got = rows(windows.gap_dwell(df, ["k"], "t", "id", cap, ["dev"]))
    want = []
    for key in sorted(set(keys)):
        mine = sorted((t, i, d) for k, t, i, d in beats if k == key)
        total, last = 0, mine[0][0]
        for t, _, _ in mine[1:]:
            total, last = total + (t - last if t - last <= cap else 0), t
        want.append((key, mine[0][2], mine[0][0], last, total))
    assert got == sorted(want, key=repr)


def test_gap_dwell_does_not_depend_on_row_order(spark, rows):
    beats = [("a", 100, 1, "x"), ("a", 100, 2, "y"), ("a", 160, 3, "z"), ("a", 231, 4, "w")]
    for order in (beats, beats[::-1]):
        df = spark.createDataFrame(order, "k string, t bigint, id int, dev string")
        assert rows(windows.gap_dwell(df, ["k"], "t", "id", 70, ["dev"])) == [("a", "x", 100, 231, 60)]


def test_consecutive_gaps_and_last_mark(spark, rows):
    df = spark.createDataFrame([("a", t) for t in (0, 95, 190, 400)] + [("b", 5)], "k string, t bigint")
    gaps = windows.consecutive_gaps(df, ["k"], "t")
    assert rows(gaps) == [
        ("a", 0, 95, 95),
        ("a", 190, 210, None),
        ("a", 400, None, None),
        ("a", 95, 95, 210),
        ("b", 5, None, None),
    ]
    assert rows(windows.mark_last(df, ["k"], "t"), "k", "t", "is_last")[2] == ("a", 400, 1)


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
@pytest.mark.parametrize("steps", [1, 2, 3])
def test_following_rows_cross_parts(spark, rows, partitions, steps):
    keys, rng = hot(300, 8)
    times = rng.sample(range(5000), len(keys))
    data = [(k if k != 3 else None, t, f"c{t}") for k, t in zip(keys, times, strict=True)]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(data, "k int, t bigint, c string")
        got = windows.following(df, ["k"], ["t"], ["t", "c"], steps).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = []
    for k, t, c in data:
        later = sorted((u, d) for j, u, d in data if j == k and u > t)[:steps]
        want.append((k, t, c, *later, *[None] * (steps - len(later))))
    assert sorted((tuple(x if not isinstance(x, tuple) else tuple(x) for x in r) for r in got), key=repr) == sorted(want, key=repr)


def test_a_busy_key_is_spread_over_parts(spark):
    df = spark.range(90000).selectExpr("IF(id % 3 = 0, -1, id) AS k", "id AS t")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in windows.dealt_by_range(df, ["k"], ["t"]).groupBy("_part").count().collect())
        gaps = windows.consecutive_gaps(df, ["k"], "t")
        tasks = sorted(r["count"] for r in gaps.groupBy(F.spark_partition_id()).count().collect())
        assert gaps.filter("gap = 3 AND k = -1").count() == 29999
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]
    assert tasks[-1] <= 3 * tasks[len(tasks) // 2]


def test_following_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "k int, t bigint")
    assert windows.consecutive_gaps(df, ["k"], "t").count() == 0
    assert windows.mark_last(df, ["k"], "t").columns == ["k", "t", "is_last"]


def test_first_k_and_beyond_first_k(spark, rows):
    keys, _ = hot(200, 2)
    df = spark.createDataFrame(list(enumerate(keys)), "id int, k int")
    first = windows.first_k(df, ["k"], ["id"], 3)
    seen, want_first, want_flag = {}, [], []
    for i, k in enumerate(keys):
        seen[k] = seen.get(k, 0) + 1
        want_flag.append((i, k, int(seen[k] > 3)))
        if seen[k] <= 3:
            want_first.append((i, k, seen[k]))
    assert rows(first) == sorted(want_first, key=repr)
    assert rows(windows.beyond_first_k(df, ["k"], "id", 3, "late")) == sorted(want_flag, key=repr)


def test_rows_without_a_key_are_never_beyond(spark, rows):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "id int, k string")
    assert rows(windows.beyond_first_k(df, ["k"], "id", 1, "late"), "id", "late") == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_first_k_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    plan = windows.first_k(df, ["k"], ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2


def test_keep_first_and_drop_later_duplicates(spark, rows):
    df = spark.createDataFrame([(1, "o", 5), (2, "o", 0), (3, "o", 7), (4, "p", 1), (5, None, 1)], "id int, o string, m int")
    assert rows(windows.keep_first(df, ["o"], ["id"])) == [(1, "o", 5), (4, "p", 1), (5, None, 1)]
    # Rows 1 and 3 count, so everything of order o after row 1 goes; other orders stay.
    kept = windows.drop_later_duplicates(df, ["o"], "id", F.col("m") > 0)
    assert rows(kept, "id") == [(1,), (4,), (5,)]
    # One counted row is no duplicate: the uncounted one stays.
    kept = windows.drop_later_duplicates(df.filter("id < 3"), ["o"], "id", F.col("m") > 0)
    assert rows(kept, "id") == [(1,), (2,)]


def test_rolling_count(spark, rows):
    df = spark.createDataFrame([("a", d) for d in (1, 1, 3, 40)], "k string, d int")
    assert rows(windows.rolling_count(df, "k", "d", 31, "n")) == [("a", 1, 2), ("a", 3, 3), ("a", 40, 1)]


# Nearest matches ------------------------------------------------------------------------


def brute_nearest(left, right, direction, tolerance, strict):
    out = []
    for i, k, t in left:
        best = None
        for j, rk, rt in right:
            if rk != k or (strict and rt == t):
                continue
            if direction == "backward" and rt > t or direction == "forward" and rt < t:
                continue
            if tolerance is not None and abs(rt - t) > tolerance:
                continue
            rank = (abs(rt - t), rt, j)
            if best is None or rank < best[0]:
                best = (rank, rt, j)
        out.append((i, best[1] if best else None, best[2] if best else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slot", [None, 50, 100000])
@pytest.mark.parametrize("direction,strict", [("backward", False), ("backward", True), ("forward", True), ("nearest", False)])
@pytest.mark.parametrize("tolerance", [None, 9])
def test_nearest_join_equals_brute_force(spark, rows, direction, strict, tolerance, slot):
    lk, rng = hot(120, 3)
    rk, _ = hot(90, 4)
    left = [(i, k, rng.randrange(0, 600)) for i, k in enumerate(lk)]
    right = [(j, k, rng.randrange(0, 600)) for j, k in enumerate(rk)]
    got = joins.nearest_join(
        spark.createDataFrame(left, "i int, k int, t bigint"),
        spark.createDataFrame(right, "j int, k int, s bigint"),
        ["k"],
        "t",
        "s",
        ["j"],
        ["j"],
        direction,
        tolerance,
        strict,
        slot,
    )
    assert rows(got, "i", "matched_time", "j") == brute_nearest(left, right, direction, tolerance, strict)


def test_nearest_lookup_answers_two_questions_at_once(spark, rows):
    asks = spark.createDataFrame([("a", 10), ("a", 10), ("b", 1)], "k string, t bigint")
    near = spark.createDataFrame([("a", 12, 1), ("a", 7, 2)], "k string, t bigint, v int")
    past = spark.createDataFrame([("a", 3, 9), ("b", 2, 8)], "k string, t bigint, w int")
    found = joins.nearest_lookup(
        asks,
        ["k"],
        "t",
        [
            joins.Lookup("near", near, "t", ["v"], ["v"], "nearest", 5),
            joins.Lookup("past", past, "t", ["w"], ["w"]),
        ],
    )
    assert rows(found, "k", "t", "near.v", "past.w") == [("a", 10, 1, 9), ("b", 1, None, None)]


# Other joins ----------------------------------------------------------------------------


def test_interval_join_includes_both_ends(spark, rows):
    points = spark.createDataFrame([("r", t) for t in (99, 100, 4000, 7300, 7301)], "room string, t bigint")
    spans = spark.createDataFrame([("r", 100, 7300), ("r", 3999, 4000), ("q", 0, 9), ("r", 50, 40), ("r", None, 9)], "room string, a bigint, b bigint")
    got = joins.interval_join(points, spans, ["room"], "t", "a", "b")
    assert rows(got, "t", "a") == [(100, 100), (4000, 100), (4000, 3999), (7300, 100)]


@pytest.mark.parametrize("slot", [1, 10, 3600])
def test_dyadic_cover_has_each_slot_once(spark, slot):
    rng = random.Random(6)
    spans = [(0, 0), (-7, 5), (0, slot * 1024 - 1), (slot, slot * 9), (-slot * 700, slot * 900)]
    spans += [(a, a + rng.randrange(0, slot * 3000)) for a in (rng.randrange(-(10**5), 10**9) for _ in range(60))]
    df = spark.createDataFrame(spans, "a bigint, b bigint")
    for row in df.select("a", "b", joins.dyadic_cover(F.col("a"), F.col("b"), slot).alias("cover")).collect():
        covered = sorted(s for c in row.cover for s in range(c.block << c.level, (c.block + 1) << c.level))
        assert covered == list(range(row.a // slot, row.b // slot + 1))
        assert len(row.cover) <= max(joins.SHORT_INTERVAL, 2 * len(covered).bit_length())


def test_a_ten_year_interval_has_few_rows(spark):
    df = spark.createDataFrame([(1262304000 + 17, 1577923200 + 99)], "a bigint, b bigint")
    assert df.select(F.size(joins.dyadic_cover(F.col("a"), F.col("b"), 3600))).first()[0] < 60
    assert df.select(F.size(joins.dyadic_cover(F.col("a"), F.col("b"), 1))).first()[0] < 60


@pytest.mark.parametrize("slot", [1, 16, 3600])
def test_interval_join_equals_brute_force(spark, rows, slot):
    keys, rng = hot(300, 7)
    points = [(i, k, rng.randrange(-500, 40000)) for i, k in enumerate(keys)] + [(999, None, 5), (998, 0, None)]
    spans = []
    for j in range(120):
        a = rng.randrange(-600, 40000)
        spans.append((j, rng.choice(keys), a, a + int(rng.paretovariate(0.4)) % 50000))
    spans += [(200, 0, -(10**9), 10**9), (201, 0, 10, 9), (202, 1, None, 50), (203, 1, 50, None), (0, 2, 7, 7), (0, 2, 7, 7)]
    got = joins.interval_join(
        spark.createDataFrame(points, "i int, k int, t bigint"), spark.createDataFrame(spans, "j int, k int, a bigint, b bigint"),
        ["k"], "t", "a", "b", slot,
    )
    assert set(got.columns) == {"i", "j", "k", "t", "a", "b"}
    whole = [s for s in spans if None not in s]
    want = [(i, j) for i, k, t in points if k is not None and t is not None for j, sk, a, b in whole if sk == k and a <= t <= b]
    assert rows(got, "i", "j") == sorted(want, key=repr)


def test_short_intervals_do_not_repeat_points(spark):
    """Only levels that occur are asked for."""
    points = spark.range(50).select(F.lit("r").alias("room"), F.col("id").alias("t"))
    spans = spark.createDataFrame([("r", 3, 9)], "room string, a bigint, b bigint")
    joined = joins.interval_join(points, spans, ["room"], "t", "a", "b")
    assert joined.count() == 7
    assert "collect_set(_level" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def shuffled(spark):
    """A session that broadcasts no side of a join."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name in names:
        spark.conf.unset(name)


def test_pairs_of_one_hot_hour_are_dealt_over_the_tasks(shuffled, rows, monkeypatch):
    """No task pairs a large cell alone, however few bytes it has; small cells, copies and nulls stay as they are."""
    monkeypatch.setattr(joins, "CELL_ROWS", 50, raising=False)
    monkeypatch.setattr(joins, "TASK_PAIRS", 1000, raising=False)
    rng = random.Random(8)
    points = [(i, 1, rng.randrange(3600, 7200)) for i in range(900)] + [(900, 1, 5000)] * 120
    points += [(1000 + i, 2, rng.randrange(0, 9000)) for i in range(40)] + [(2000, None, 5), (2001, 1, None)]
    spans = [(j, 1, a, min(a + rng.randrange(0, 3000), 7199)) for j in range(180) for a in [rng.randrange(3600, 7200)]]
    spans += [(300 + j, 2, a, a + 4000) for j in range(9) for a in [rng.randrange(0, 9000)]] + [(0, 1, 3600, 7199)] * 3
    left = shuffled.createDataFrame(points, "i int, k int, t bigint").withColumn("m", F.create_map("i", "t"))
    right = shuffled.createDataFrame(spans, "j int, k int, a bigint, b bigint")
    got = joins.interval_join(left, right, ["k"], "t", "a", "b")
    assert set(got.columns) == {"i", "j", "k", "t", "m", "a", "b"}
    whole = [p for p in points if None not in p]
    want = [(i, j) for i, k, t in whole for j, sk, a, b in spans if sk == k and a <= t <= b]
    assert rows(got, "i", "j") == sorted(want, key=repr)
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 4 and max(tasks) < len(want) / 2


def test_cells_of_few_bytes_are_not_merged_into_few_tasks(shuffled, monkeypatch):
    monkeypatch.setattr(joins, "TASK_PAIRS", 1000, raising=False)
    points = shuffled.range(4000).select("id", (F.col("id") % 40).alias("k"), (F.col("id") % 3600).alias("t"))
    spans = shuffled.range(400).select((F.col("id") % 40).alias("k"), F.col("id").alias("a"), (F.col("id") + 3000).alias("b"))
    joined = joins.interval_join(points, spans, ["k"], "t", "a", "b")
    tasks = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert len(tasks) == 4 and max(tasks) < sum(tasks) / 2


def like(value, pattern):
    return re.fullmatch(re.escape(pattern).replace("%", ".*").replace("_", "."), value, re.S) is not None


def test_pattern_join_equals_brute_force(spark, rows):
    rng = random.Random(5)
    values = sorted({"".join(rng.choice("ab1") for _ in range(rng.randrange(0, 7))) for _ in range(80)})
    patterns = sorted({"".join(rng.choice("ab1%_") for _ in range(rng.randrange(0, 5))) for _ in range(80)} | {"%", "_%", ""})
    v = spark.createDataFrame([(x, i) for i, x in enumerate(values * 2)], "v string, i int")
    p = spark.createDataFrame([(x,) for x in patterns], "p string")
    got = rows(joins.pattern_join(v, p, "v", "p"), "i", "v", "p")
    want = [(i, x, y) for i, x in enumerate(values * 2) for y in patterns if like(x, y)]
    assert got == sorted(want, key=repr)
    assert fnmatch.fnmatch("ab", "a*") and like("ab", "a%")


def test_values_are_cut_by_the_shapes_of_patterns_only(spark):
    p = spark.createDataFrame([("ab%",), ("cd%",), ("x%",), ("%yz",), ("%mid%x%",), ("_",), ("%longer than eight%",)], "p string")
    shapes = p.select(joins._filed(F.col("p")).alias("f")).select("f.kind", "f.length").distinct()
    assert sorted(map(tuple, shapes.collect())) == [("i", 0), ("i", 3), ("i", 8), ("p", 1), ("p", 2), ("s", 2)]
    long = "".join(random.Random(4).choice("abcdefghij") for _ in range(10_000))
    cut = shapes.select(F.struct("kind", "length").alias("s")).select(
        F.size(joins._pieces(F.lit(long), F.col("s"))).alias("long"), F.size(joins._pieces(F.lit(""), F.col("s"))).alias("empty")
    )
    sizes = cut.agg(F.sum("long"), F.sum("empty")).first()
    assert 4 < sizes[0] <= 4 + 2 * len(long)
    assert sizes[1] == 1


def test_patterns_that_are_null_empty_or_repeated(spark, rows):
    v = spark.createDataFrame([("",), ("a",), (None,), ("a",)], "v string")
    p = spark.createDataFrame([("",), (None,), ("%",), ("a",), ("a",)], "p string")
    got = rows(joins.match_patterns(v, p, "v", "p"), "v", "p")
    assert got == [("", "%"), ("", ""), ("a", "%"), ("a", "a"), ("a", "a")]
    assert joins.match_patterns(v, p.filter("p = 'q'"), "v", "p").count() == 0


def test_pattern_join_with_escaped_wildcard(spark, rows):
    v = spark.createDataFrame([("a_b",), ("axb",), ("50%",), ("50x",)], "v string")
    p = spark.createDataFrame([("a\\_b",), ("%\\%",)], "p string")
    assert rows(joins.pattern_join(v, p, "v", "p")) == [("50%", "%\\%"), ("a_b", "a\\_b")]


def test_best_pattern_takes_rank_then_length_then_smallest_tie(spark, rows):
    v = spark.createDataFrame([("abc",), ("zzz",)], "v string")
    p = spark.createDataFrame([(1, "a%", 1), (2, "ab%", 1), (3, "%bc", 1), (4, "z%", 2), (5, "%z", 2)], "id int, p string, g int")
    got = joins.best_pattern(v, p, "v", "p", ["id"], F.col("g"), "id")
    assert rows(got) == [("abc", 2), ("zzz", 4)]


def test_enrich_keeps_unmatched_and_takes_one_partner(spark, rows):
    df = spark.createDataFrame([(1, "old"), (2, "old")], "k int, c string")
    other = spark.createDataFrame([(1, 9, "late"), (1, 3, "early")], "k int, t int, c string")
    assert rows(joins.enrich(df, other, ["k"], ["c"], ["t"])) == [(1, "early"), (2, "old")]


def test_label_precedence_last_rule_wins(spark, rows):
    df = spark.range(4)
    label = joins.label_by_precedence([(F.col("id") > 0, 1), (F.col("id") > 1, 3), (F.col("id") == 3, 2)])
    assert rows(df.select("id", label.alias("x"))) == [(0, 0), (1, 1), (2, 3), (3, 2)]


def test_memberships_with_repeated_list_rows(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,)], "uid int")
    a, b = spark.createDataFrame([(1,), (1,)], "uid int"), spark.createDataFrame([(1,), (2,)], "uid int")
    got = joins.with_memberships(df, "uid", {"in_a": a, "in_b": b})
    assert rows(got) == [(1, True, True), (2, False, True), (3, False, False)]


# Merges ---------------------------------------------------------------------------------


def test_merge_modes(spark, rows):
    old = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, n int, first int")
    new = spark.createDataFrame([("b", 5, 50), ("c", 7, 70)], "k string, n int, first int")
    assert rows(merge.merge_replace(old, new, ["k"], ["n"])) == [("a", 1, 10), ("b", 5, 20), ("c", 7, 70)]
    assert rows(merge.merge_add(old, new, ["k"], ["n"], ["first"])) == [("a", 1, 10), ("b", 7, 20), ("c", 7, 70)]
    assert rows(merge.merge_ignore(old, new, ["k"])) == [("a", 1, 10), ("b", 2, 20), ("c", 7, 70)]


def test_merge_replace_can_set_null(spark, rows):
    old = spark.createDataFrame([("a", 1)], "k string, n int")
    new = spark.createDataFrame([("a", None)], "k string, n int")
    assert rows(merge.merge_replace(old, new, ["k"], ["n"])) == [("a", None)]


def test_assemble_undo_roll_and_drop(spark, rows):
    a = spark.createDataFrame([("x", 1)], "k string, m int")
    b = spark.createDataFrame([("x", 5), ("y", 6)], "k string, n int")
    assert rows(merge.assemble([a, b], ["k"])) == [("x", 1, 5), ("y", 0, 6)]
    state = spark.createDataFrame([(1, 20160520, 7), (2, 20160519, 8)], "uid int, dt2 int, m2 int")
    assert rows(merge.undo_day(state, 20160520, "dt2", ["m2"])) == [(1, 0, 0), (2, 20160519, 8)]
    day = 100 * 86400
    old = spark.createDataFrame([(day - 32 * 86400,), (day - 31 * 86400,), (day + 1,)], "dateline bigint")
    new = spark.createDataFrame([(day - 5,), (day + 1,)], "dateline bigint")
    assert rows(merge.roll(old, new, day)) == [(day - 31 * 86400,), (day + 1,)]
    flags = spark.createDataFrame([(0,), (1,), (None,)], "z int")
    assert rows(merge.drop_rows(flags, F.col("z") == 0)) == [(1,), (None,)]


# Aggregates -----------------------------------------------------------------------------


def test_distinct_if(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 20), ("a", 2, 1), ("b", None, 9)], "k string, u int, m int")
    got = aggs.distinct_if(df, ["k"], "u", {"all": F.lit(True), "big": F.col("m") >= 11})
    assert rows(got) == [("a", 2, 1)]


def test_total_row_and_buckets(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, 7)], "room int, n int").withColumn("p", F.lit(0))
    got = aggs.with_total_row(df, ["p"], {"room": F.lit(100)}, ["n"])
    assert rows(got, "room", "n") == [(1, 5), (100, 12), (2, 7)]
    beats = spark.createDataFrame([("d", 10), ("d", 19), ("d", 20)], "k string, t bigint")
    assert rows(aggs.time_bucket_count(beats, ["k"], "t", 10, "n")) == [("d", 2)]
    assert rows(aggs.span(beats, ["k"], "t", "s")) == [("d", 10)]


def test_first_k_limits_before_the_shuffle_for_any_k(spark):
    df = spark.range(100_000).selectExpr("id % 2 AS k", "id")
    plan = windows.first_k(df, ["k"], ["id"], 5000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_no_shared_folder_is_an_error(spark):
    from nightledger.session import shared_folder

    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
