"""The pipeline's stages keep columns of any name, with their values."""

import random

import pytest
from helpers import prose

import corpus_pipeline
from nightledger.llm import benchmarks, languages, mixing, periods, setsketch, substrings, toxicity
from nightledger.llm.frames import Carried, ready

NAMES = "_ key key1 c place _key dropped row home my-col a`b a.b TEXT2 score held_out predicted n_words matches size rows".split() + ["a b", "doc", "mark", "one"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    ready(spark)
    sf = str(tmp_path_factory.mktemp("odd"))
    rng = random.Random(1)
    toxic = [(i, i % 2 * 0, int(i % 4 == 0)) for i in range(60)]
    spark.createDataFrame(toxic, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, " ".join(prose(900, 20)))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    rows = []
    for i in range(60):
        words = prose(i, 40) + (["vile", "scum"] * 4 if i % 4 == 0 else [])
        words = prose(900, 20) if i == 7 else prose(5, 40) if i == 9 else words + (prose(77, 20) if i % 5 == 1 else [])
        rng.shuffle(words) if i % 4 == 0 else None
        rows.append((i, " ".join(words), "en", f"s{i % 3}", None))
    rows += [(100, None, None, None, None), (101, "", "en", "s1", 3), (None, "no id", "en", "s1", 3), rows[2], rows[2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return sf, docs.cache()


def run(spark, docs, sf, name, stage):
    return stage(spark, docs, sf)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_of_any_name(spark, tables, name, stage):
    sf, docs = tables
    odd = docs.toDF(*docs.columns)
    for i, extra in enumerate(NAMES):
        odd = odd.select("*", mixing.F.concat(mixing.F.lit(f"{i}-"), mixing.F.col("doc_id").cast("string")).alias(extra))
    odd = odd.toDF(*docs.columns, *NAMES)
    plain, got = stage(spark, docs, sf), stage(spark, odd, sf)
    added = [c for c in plain.columns if c not in docs.columns]
    assert got.columns == [*docs.columns, *NAMES, *added]
    rows = [tuple(r) for r in got.collect()]
    n = len(docs.columns)
    for r in rows:
        for i, value in enumerate(r[n : n + len(NAMES)]):
            assert value == (None if r[0] is None else f"{i}-{r[0]}")
    if name != "source_mixing":  # all columns enter the random numbers of the mix
        assert sorted((r[:n] for r in rows), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    assert 0 < len(rows) <= docs.count()


def test_names_that_differ_in_case_only(spark):
    df = spark.createDataFrame([(1, "a b", "X")], "doc_id long, text string, t string").toDF("doc_id", "text", "TEXT")
    out = periods.periodic_runs(df)
    assert [tuple(r)[:3] for r in out.collect()] == [(1, "a b", "X")]
    carried = Carried(df, "doc_id", "text", without=("none",))
    assert [tuple(r) for r in carried.back(carried.work).collect()] == [(1, "a b", "X")]
    with pytest.raises(ValueError, match="no column"):
        Carried(df, "vec")
    assert [tuple(r) for r in setsketch.drop_near_duplicates(df).collect()] == [(1, "a b", "X")]
    assert [tuple(r) for r in substrings.remove_repeats(df).collect()] == [(1, "a b", "X")]
    assert languages and toxicity and benchmarks
