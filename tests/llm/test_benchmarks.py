import hashlib
import re

import numpy as np
import pyarrow as pa
from helpers import frame, prose, tuples  # noqa: F401

from nightledger.llm import benchmarks
from nightledger.llm.words import ALNUM, Words, buffers


def words_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(rows, items, size=13):
    windows = {}
    for name, text in items:
        w = words_of(text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add("" if name is None else str(name))
    out = []
    for doc, text in rows:
        w, hit, found = words_of(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


ITEMS = [(i, " ".join(prose(i, 15 + 3 * i))) for i in range(8)]
ITEMS += [(20, "Short Item é"), (21, None), (22, ""), (23, "..."), (24, ITEMS[3][1]), (25, "the the the the"), (3, ITEMS[3][1])]
ITEMS += [(None, "item without any name here")]


def documents():
    rows = []
    for i in range(30):
        inner = words_of(ITEMS[i % 8][1])
        cut = inner if i % 3 else inner[: 12 + i % 4]
        rows.append((i, " ".join(prose(100 + i, 5 * i) + [w.upper() for w in cut] + prose(200 + i, 40))))
    rows += [(40, None), (41, ""), (42, "the the the the the the"), (43, "an Item: short-item É? short item é"), (0, rows[0][1])]
    rows += [(44, " ".join(words_of(ITEMS[7][1]) * 300)), (None, ITEMS[2][1]), (45, "an item without any name here")]
    return rows


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_equals_brute_force(spark, frame):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute(documents(), ITEMS)
    assert tuples(benchmarks.contamination(frame(documents()).repartition(4), items), *COLUMNS) == want
    assert any(r[2] for r in want) and not all(r[5] for r in want)


def test_blocks_of_items_change_nothing(spark, frame):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = benchmarks.contamination(frame(documents()), items, block_bytes=300)
    assert tuples(got, *COLUMNS) == brute(documents(), ITEMS)


def test_matches_are_the_longest(spark):
    item = prose(1, 40)
    text = prose(2, 10) + item[5:30] + prose(3, 4) + item[20:40]
    block = benchmarks.Block(["x"], [" ".join(item)], 13)
    words = Words(*buffers(pa.array([" ".join(text)])), ALNUM, lower=True)
    got = list(zip(*(a.tolist() for a in block.matches(words)), strict=True))
    assert (0, 10, 0, 5, 25) in got and (0, 39, 0, 20, 20) in got and len(got) == 2


def test_large_vocabulary_packs_in_order():
    block = benchmarks.Block(["x"], [" ".join(f"w{i}" for i in range(5000))], 13)
    rng = np.random.default_rng(1)
    numbers = rng.integers(0, 5001, (300, 13))
    keys = block.pack(numbers)
    assert np.array_equal(np.argsort(keys, kind="stable"), np.lexsort(numbers.T[::-1]))


def test_decontaminate_keeps_the_rest(spark, frame):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame(documents()).withColumnRenamed("lang", "n_hit").withColumnRenamed("source", "matches")
    out = benchmarks.decontaminate(docs, items)
    assert out.columns == docs.columns
    bad = [r[0] for r in brute(documents(), ITEMS) if r[5]]
    want = sorted((r[0] for r in documents() if r[0] not in bad), key=repr)
    assert sorted((r.doc_id for r in out.collect()), key=repr) == want


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert benchmarks.contamination(frame([]), none).count() == 0
    assert [r.contaminated for r in benchmarks.contamination(frame([(1, "a b")]), none).collect()] == [False]


def test_one_block_of_items_is_alive_at_a_time(spark, frame, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    steps, build, destroy = [], benchmarks.Block.__init__, benchmarks.Broadcast.destroy
    monkeypatch.setattr(benchmarks.Block, "__init__", lambda self, *a: (steps.append("build"), build(self, *a))[1])
    monkeypatch.setattr(benchmarks.Broadcast, "destroy", lambda self, *a: (steps.append("destroy"), destroy(self, *a))[1])
    got = benchmarks.contamination(frame(documents()), items, block_bytes=300)
    assert tuples(got, *COLUMNS) == brute(documents(), ITEMS)
    assert steps.count("build") > 2 and all(a != b for a, b in zip(steps[:-1], steps[1:], strict=True))
