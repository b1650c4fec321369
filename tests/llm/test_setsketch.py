import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import frame, prose, tuples  # noqa: F401
from pyspark.sql import functions as F

from nightledger.llm import setsketch
from nightledger.llm.components import components
from nightledger.llm.words import SPACED, Words, buffers


def shingle_set(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return set()
    return {tuple(w)} if len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if None not in (i, j) and a and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return sorted(((i, len(s), root(i), root(i) == i) for i, s in sets), key=repr)


def corpus():
    rng, rows = random.Random(4), []
    for base in range(25):
        words = prose(base, rng.choice([3, 6, 20, 80, 300]), extra=5000)
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            copy = [w if rng.random() > 0.02 else f"c{rng.randrange(999)}" for w in words]
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    big = prose(99, 200, extra=5000)
    for n in range(40):
        copy = list(big)
        for _ in range(rng.choice([0, 1, 3, 6, 9])):
            copy[rng.randrange(len(copy))] = f"z{rng.randrange(9999)}"
        rows.append((2000 + n, " ".join(copy).upper() if n % 2 else " ".join(copy)))
    return rows + [(3000, None), (3001, ""), (3002, " \n"), (3003, "One two"), (3004, "one TWO"), (None, rows[0][1]), (5, "five"), (5, "five")]


def test_equals_brute_force(spark, frame):
    rows = corpus()
    got = setsketch.near_duplicates(frame(rows).repartition(4))
    assert tuples(got, "doc_id", "n_shingles", "component_id", "kept") == brute(rows)


def test_small_blocks_change_nothing(spark, frame, monkeypatch):
    rows = corpus()
    for name, value in {"BLOCK": 12, "GROUP_ROWS": 400, "GROUP_BYTES": 200_000, "PAIRS_AT_ONCE": 50, "BROADCAST_BYTES": 0}.items():
        monkeypatch.setattr(setsketch, name, value)
    got = setsketch.near_duplicates(frame(rows))
    assert tuples(got, "doc_id", "n_shingles", "component_id", "kept") == brute(rows)


def test_every_open_pair_of_a_bucket_meets(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 4)
    met, likely = set(), setsketch._likely_pairs
    row = np.arange(setsketch.REGISTERS, dtype=np.uint16).tobytes()
    members = [(1, 0, i, i % 3, 15, 50, row) for i in range(15)] + [(2, 0, i, 0, 3, 50, row) for i in range(3)]
    schema = "key long, band int, id long, component long, members long, n long, registers binary"
    cells = setsketch._cells(spark.createDataFrame(members, schema)).select(*setsketch._CELL).toPandas()
    cells = setsketch._sorted(cells)
    for left, right, _ in likely(cells):
        met |= {tuple(sorted((int(cells["id"][i]), int(cells["id"][j])))) for i, j in zip(left, right, strict=True)}
    assert met == {(i, j) for i in range(15) for j in range(i + 1, 15) if i % 3 != j % 3}


def registers_of(numbers):
    values = np.sort(np.random.default_rng(3).integers(0, 1 << 63, 4000, dtype=np.uint64)[numbers])
    return setsketch.registers(values, np.array([0, len(values)]))


def test_large_cells_are_dealt_alone(spark):
    cells = [(k, x, x, 5000) for k in range(20) for x in range(10)] + [(100 + k, 0, 0, 3) for k in range(300)]
    frame = spark.createDataFrame(cells, "key long, x int, y int, members long")
    dealt = setsketch._dealt(frame, "1", 100).groupBy("deal").agg(F.max("members").alias("most"), F.count("*").alias("n")).collect()
    assert sum(r.most == 5000 for r in dealt) == 200 and all(r.n == 1 for r in dealt if r.most == 5000)
    assert sum(r.most == 3 for r in dealt) <= 3


def test_registers_merge_to_those_of_the_union():
    one, two = registers_of(np.arange(0, 600)), registers_of(np.arange(400, 1500))
    assert (setsketch.merge(one, two) == registers_of(np.arange(0, 1500))).all()


@pytest.mark.parametrize("shared", [200, 600, 900])
def test_likelihood_estimate(shared):
    one, two = registers_of(np.arange(0, 1000)), registers_of(np.arange(1000 - shared, 2000 - shared))
    n = np.array([1000.0])
    est = setsketch.similarity((one > two).sum(1), (one < two).sum(1), n, n)[0]
    assert abs(est - shared / (2000 - shared)) < 0.15


def test_shingles_are_distinct():
    text = ["a b c d e a b c d e", "a b", "", "a b c d e"]
    values, first = setsketch.shingles(Words(*buffers(pa.array(text)), SPACED))
    assert np.diff(first).tolist() == [5, 1, 0, 1]


def test_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 100), (7, 7), (200, 200)] + [(300, 300 + i) for i in range(1, 50)]
    got = dict(tuples(components(spark.createDataFrame(links, "a long, b long"))))
    want = {i: 0 for i in range(61)} | dict.fromkeys((100, 101, 102), 100) | {300 + i: 300 for i in range(50)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drop_keeps_rows_without_id(spark, frame):
    rows = [(2, "a b c d e f"), (1, "A b c d e f"), (None, "a b c d e f"), (3, None)]
    docs = frame(rows).withColumnRenamed("lang", "kept").withColumnRenamed("source", "registers")
    out = setsketch.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == [1, 3, None]


def test_empty_table(spark, frame):
    assert setsketch.near_duplicates(frame([])).count() == 0
