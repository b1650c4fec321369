import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import frame, prose  # noqa: F401
from pyspark.sql import functions as F

from nightledger.llm import substrings


def brute(rows, size):
    first = {}
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (i, _), w in zip(rows, words, strict=True):
        for k in range(len(w) - size + 1):
            key, own = tuple(w[k : k + size]), float("inf") if i is None else i
            first[key] = min(first.get(key, own), own)
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone, own = set(), float("inf") if i is None else i
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < own:
                gone |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    shared, line = prose(1, 60), prose(2, 13)
    rows = [(i, " ".join(prose(10 + i, 30) + (shared if i % 3 == 0 else []) + prose(90 + i, 20))) for i in range(40)]
    rows += [(50 + i, "\n".join([" ".join(line)] * (i + 1))) for i in range(4)]
    rows += [(60, rows[5][1]), (61, rows[5][1]), (61, rows[5][1]), (61, " ".join(shared)), (None, rows[3][1])]
    rows += [(70, None), (71, ""), (72, " \n\t"), (73, "one"), (-4, " ".join(shared[:30])), (74, "x " * 5000)]
    return rows


def test_equals_brute_force(spark, frame):
    rows = corpus()
    got = substrings.repeated_words(frame(rows).repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 13)


@pytest.mark.parametrize("load", [0.5, 1e6])
def test_many_blocks_and_a_full_sketch_change_nothing(spark, frame, monkeypatch, load):
    rows = corpus()
    for name, value in {"BLOCK_BITS": 5, "LOAD": load, "HOME_BYTES": 2000, "BUCKET_BYTES": 999}.items():
        monkeypatch.setattr(substrings, name, value)
    got = substrings.repeated_words(frame(rows).repartition(7))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 13)


def test_sketch_never_underestimates_and_passes_few_single_windows(spark, frame, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BITS", 8)
    rows = corpus() + [(100 + i, " ".join(prose(500 + i, 200, 10**6))) for i in range(40)]
    docs = frame(rows).select("text").withColumn("home", F.pmod(F.xxhash64("text"), F.lit(9)).cast("int"))
    texts = docs.toArrow()
    blocks, home = 2 * 16000 // 256, texts.column("home").to_numpy()
    heard = substrings.repeated_cells(docs, blocks).toArrow()
    _, _, keys = substrings._window_keys(texts, 13)
    _, at, n = np.unique(keys[0], return_inverse=True, return_counts=True)
    single = passed = 0
    for one in range(9):
        own = texts.filter(pa.array(home == one))
        _, _, found = substrings._window_keys(own, 13)
        reply = heard.filter(pa.array(heard.column("home").to_numpy() == one))
        repeated = substrings._repeated(found, reply, blocks, 8)
        count = n[np.searchsorted(np.unique(keys[0]), found[0])]
        assert repeated[count > 1].all()
        single, passed = single + (count == 1).sum(), passed + repeated[count == 1].sum()
    assert single > 5000 and passed < 0.2 * single


def test_equal_rows_are_dealt_over_homes_and_texts_shuffled_once(spark, frame, monkeypatch):
    monkeypatch.setattr(substrings, "HOME_BYTES", 2000)
    rows = corpus() + [(7, corpus()[8][1])] * 60
    out = substrings.repeated_words(frame(rows).repartition(6))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, 13)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


def test_remove_repeats_keeps_columns_and_untouched_texts(spark, frame):
    rows = corpus()
    docs = frame(rows).withColumnRenamed("lang", "n_removed")
    out = substrings.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert (71, "") in got and (70, None) in got and (72, " \n\t") in got
    assert (1, rows[1][1]) in got
    assert (60, "") in got and got[(60, "")].n_chars == 0


def test_empty_table(spark, frame):
    assert substrings.repeated_words(frame([])).count() == 0
    assert substrings.remove_repeats(frame([])).count() == 0
