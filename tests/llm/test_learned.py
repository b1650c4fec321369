"""Classifiers, nearest neighbours and the pipeline on small tables with known answers."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import frame, prose  # noqa: F401

import corpus_pipeline
from nightledger.llm import gru, neighbours, quality, toxicity
from nightledger.llm.words import buffers


def is_held_out(i, mod, rest):
    return zlib.crc32(str(i).encode()) % mod == rest


def judged(got, label, mod, rest):
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and is_held_out(r.doc_id, mod, rest)) for r in got)
    own = [r for r in got if r.held_out and r.doc_id in label]
    return np.mean([r.predicted == label[r.doc_id] for r in own])


EXTRA = [(5000, None), (5001, ""), (5002, " "), (5003, "word " * 9000), (None, "no id here"), (7, "same id again")]


def test_toxicity_learns_words_and_their_parts(spark, frame, monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 4)
    rng, rows, label = random.Random(2), [], {}
    for i in range(400):
        words, toxic = prose(i, rng.choice([20, 60, 200])), i % 3 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vilefoo", "grimbar", f"zqzq{rng.randrange(99)}"])
        rows.append((i, " ".join(words)))
        label[i] = int(toxic)
    labels = spark.createDataFrame([(i, 1, v) for i, v in label.items()] + [(3, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    docs = frame(rows + EXTRA).withColumnRenamed("lang", "score")
    got = toxicity.toxicity_scores(docs, labels).collect()
    assert len(got) == len(rows) + len(EXTRA)
    assert judged([r for r in got if r.doc_id != 7], label, 5, 0) > 0.9


def test_gradients(spark):
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru.initial().items()}
    inputs, start, size = rng.standard_normal((12, 2 * gru.WIDTH)), np.array([0, 5]), np.array([5, 7])

    def loss():
        logit = gru.forward(p, inputs, start, size)
        return float((np.log1p(np.exp(logit)) * [1, 2]).sum())

    kept = {}
    logit = gru.forward(p, inputs, start, size, kept)
    grad, d_inputs = gru.backward(p, inputs, kept, np.array([1, 2]) / (1 + np.exp(-logit)))
    for array, slope in [(p[k], grad[k]) for k in grad] + [(inputs, d_inputs)]:
        for at in rng.integers(0, array.size, 3):
            flat, old = array.reshape(-1), array.reshape(-1)[at]
            flat[at] = old + 1e-3
            up = loss()
            flat[at] = old - 1e-3
            slope_at = (up - loss()) / 2e-3
            flat[at] = old
            assert slope_at == pytest.approx(slope.reshape(-1)[at], abs=2e-3)


def test_windows_cover_every_word():
    texts = ["", "a", "b " * 48, "c " * 49, "d " * 200]
    coded = gru.Encoded(*buffers(pa.array(texts)))
    for i, n in enumerate(coded.counts):
        covered = set()
        for s, k in zip(coded.start[coded.text == i], coded.size[coded.text == i], strict=True):
            covered |= set(range(s - coded.first[i], s - coded.first[i] + k))
        assert covered == set(range(n))


def test_short_passages_lie_whole_in_a_window():
    texts = [" ".join(prose(n, n)) for n in (1, 47, 48, 49, 60, 72, 73, 200)]
    coded = gru.Encoded(*buffers(pa.array(texts)))
    for i, n in enumerate(coded.counts):
        own = coded.text == i
        lo, hi = coded.start[own] - coded.first[i], coded.start[own] - coded.first[i] + coded.size[own]
        size = min(int(n), gru.WINDOW // 2)
        assert all(((lo <= at) & (at + size <= hi)).any() for at in range(n - size + 1))


def test_dropping_toxic_documents_keeps_their_columns(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame([(1, "a b"), (2, None)]).selectExpr("doc_id", "text", "7 as score", "'mine' as held_out", "doc_id * 2 as Predicted", "n_chars as `a b`")
    model = gru.initial()
    model["o"][:], model["ob"][:] = 0, -1
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "fit", lambda *_: model)
        out = toxicity.drop_toxic(docs, none)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        assert sorted(map(tuple, out.collect())) == [(1, "a b", 7, "mine", 2, 3), (2, None, 7, "mine", 4, None)]


def test_quality_learns_statistics(spark, frame):
    rng, rows, label = random.Random(3), [], {}
    for i in range(400):
        words, good = prose(i, rng.choice([20, 60, 200])), i % 4 != 0
        if not good:
            words = [w.upper() + "!!" for w in words] if i % 8 else [w for w in words[:5] for _ in range(12)]
        rows.append((i, " ".join(words)))
        label[i] = int(good)
    labels = spark.createDataFrame([(i, v, 0) for i, v in label.items()], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(frame(rows + EXTRA).withColumnRenamed("lang", "held_out"), labels).collect()
    assert len(got) == len(rows) + len(EXTRA)
    assert judged([r for r in got if r.doc_id != 7], label, 3, 1) > 0.95


def test_without_labels_every_score_is_one_half(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame([(1, "a b"), (2, None)])
    for got in (quality.quality_scores(docs, none), toxicity.toxicity_scores(docs, none)):
        assert [r.score for r in got.collect()] == [0.5, 0.5]
    assert quality.quality_scores(frame([]), none).count() == 0
    assert toxicity.toxicity_scores(frame([]), none).count() == 0


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    rows = rng.standard_normal((500, 6)).astype(np.float32)
    trees = quality.grow(rows, (rows[:, 1] * rows[:, 3] > 0).astype(float))
    for i in range(20):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if rows[i, f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        assert trees.scores(rows[i : i + 1])[0] == pytest.approx(1 / (1 + np.exp(-total)))


VECTORS = "vec_id long, embedding array<float>, label int"


def exact(rows, every, count):
    good = {}
    for i, v in rows:
        if i is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v):
            good.setdefault((i, tuple(np.float32(v).tolist())), np.array(np.float32(v), float))
    out = {}
    for (i, _), v in good.items():
        if i % every == 0:
            best = {}
            for (j, _), w in good.items():
                if j != i:
                    best[j] = max(best.get(j, -np.inf), float((v * w).sum()))
            out[i] = sorted(((-s, j) for j, s in best.items()))[:count]
    return out


def test_neighbours(spark, frame, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_SIZE", 40)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((9, 16))
    rows = [(i, (centres[i % 9] + 0.5 * rng.standard_normal(16)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [(0, rows[0][1])]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [None] * 16), (2080, [1.0] * 3), (None, rows[1][1])]
    rows += [(2100, [float("inf")] * 16)]
    got = neighbours.nearest(spark.createDataFrame([(*r, 0) for r in rows], VECTORS).repartition(5)).collect()
    want, by = exact(rows, 20, 20), {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    assert by.keys() == want.keys()
    hits = 0
    for q, found in by.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and [f[1:] for f in found] == sorted(f[1:] for f in found)
        hits += len({f[2] for f in found} & {j for _, j in want[q]})
    assert hits >= 0.9 * 20 * len(want)
    copies = [f[2] for f in by[1000] if f[2] == 3 or f[2] > 1000]  # equal vectors by id, the query itself left out
    assert copies == [3, *range(1001, 1060)][: len(copies)]


def test_short_lists_are_refilled(spark, monkeypatch):
    rng = np.random.Generator(np.random.PCG64(5))
    middle = rng.normal(size=(60, 8)) * 10
    rows = [(i, [float(x) for x in middle[i % 60] + rng.normal(size=8) / 100]) for i in range(600)]
    for name, value in {"LIST_SIZE": 8, "COVER": 0.01, "SAMPLE_BYTES": 8 * 8 * 500}.items():
        monkeypatch.setattr(neighbours, name, value)
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r["rank"])
    assert by.keys() == set(range(0, 600, 20)) and all(sorted(x) == list(range(1, 21)) for x in by.values())


def test_few_vectors(spark, frame):
    rows = [(0, [1.0, 0.0], 0), (1, [2.0, 0.0], 0), (2, [-1.0, 1.0], 0)]
    got = [tuple(r) for r in neighbours.nearest(spark.createDataFrame(rows, VECTORS)).collect()]
    assert sorted(got) == [(0, 1, 1, 2.0), (0, 2, 2, -1.0)]
    assert neighbours.nearest(spark.createDataFrame([], VECTORS)).count() == 0


def test_double_vectors_keep_their_components(spark):
    rows = [(0, [1.0, 0.1]), (1, [1.0, 0.1 + 1e-12]), (2, [1.0, 0.1 + 2e-12]), (3, [1e39, 1.0]), (4, [1e-60, 0.0]), (5, [1e-200, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in neighbours.nearest(vectors).orderBy("rank").collect()]
    score = {i: x + 0.1 * y for i, (x, y) in rows}
    assert got == [(0, k + 1, i, pytest.approx(score[i], rel=1e-15)) for k, i in enumerate([3, 2, 1, 4, 5])]
    assert got[1][3] > got[2][3]


def test_neighbours_at_any_magnitude(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((60, 8))
    want = None
    for factor in (1.0, 2.0**400, 2.0**-400):
        rows = [(i, (p * factor).tolist()) for i, p in enumerate(points)]
        got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect())
        want = want or got
        assert got == want and len(got) == 60


def test_graph_search_finds_the_nearest():
    sample = np.random.default_rng(2).standard_normal((4000, 8))
    index = neighbours.Index(sample, 400_000, float(np.linalg.norm(sample, axis=1).max()))
    rows = index.lifted(sample[:200])
    ids, far = index.search(rows, 16)
    true = neighbours._distances(rows, index.centroids)
    assert len(index.centroids) > 300 and (np.diff(far, axis=1) >= 0).all()
    assert np.mean(ids[:, 0] == true.argmin(1)) > 0.97


def test_pipeline_decisions_take_effect(spark, frame, tmp_path):
    rng, rows, labels = random.Random(1), [], []
    passage, item = prose(501, 60), prose(502, 30)
    for i in range(150):
        words = prose(i, 80, extra=3000)
        if i % 5 == 0:
            for _ in range(6):
                words[rng.randrange(len(words))] = rng.choice(["vilefoo", "grimbar"])
        rows.append((i, " ".join(words), f"s{i % 4}"))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(200, rows[1][1], "s0"), (201, rows[2][1] + " tail", "s1")]
    rows += [(210 + k, " ".join(prose(700 + k, 60, extra=3000) + passage), "s2") for k in range(2)]
    rows += [(220, " ".join(prose(800, 60, extra=3000) + item), "s3")]
    sf = str(tmp_path)
    frame(rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if place < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{sf}/out{place}")
        docs = spark.read.parquet(f"{sf}/out{place}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
    toxic = {i for i, _, t in labels if t}
    assert len(kept["toxicity"].keys() & toxic) <= 3 and len(kept["toxicity"].keys() - toxic) >= 120
    assert not kept["near_duplicates"].keys() & {200, 201} or not kept["toxicity"].keys() >= {1, 2}
    assert " ".join(passage) in kept["substring_dedup"][210].text
    assert " ".join(passage) not in kept["substring_dedup"][211].text
    assert kept["decontamination"].keys() == kept["substring_dedup"].keys() - {220}
    assert all(r.copies in (1, 2) for r in kept["source_mixing"].values())
    assert kept["source_mixing"].keys() <= kept["decontamination"].keys()
    assert corpus_pipeline.run(spark, sf).count() == len(kept["source_mixing"])
