import math
import random
import re

import numpy as np
from helpers import frame, prose, tuples  # noqa: F401

from nightledger.llm import ranking

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def brute(docs, items, top):
    terms = [[t.translate(UPPER) for t in TERM.findall(text or "")] for _, text in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    out = []
    for item, text in set(items):
        scored = []
        for (doc, _), own in zip(docs, terms, strict=True):
            score = 0
            for term in {t.translate(UPPER) for t in TERM.findall(text or "")} & set(own):
                df, tf = sum(term in t for t in terms), own.count(term)
                m = 50 + 50 * len(own) * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(3)
    docs = [(i, " ".join(prose(i, rng.randrange(1, 80), 60))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(6)] + [(7, docs[7][1]), (None, docs[7][1]), (None, docs[8][1])]
    docs += [(300, None), (301, ""), (302, "!? -"), (303, "The THE the"), (-5, "W1é " * 3000), (304, "É é w1é")]
    items = [(i, " ".join(prose(1000 + i, 12, 60))) for i in range(12)] + [(50, docs[7][1]), (50, docs[9][1]), (50, docs[7][1])]
    items += [(60, None), (61, ""), (62, "unknown words"), (63, "the"), (None, "w1é W1É of"), (64, "!!")]
    return docs, items


def test_equals_brute_force_in_any_blocks(spark, frame, monkeypatch):
    docs, items = corpus()
    asked = spark.createDataFrame(items, ITEMS)
    want = {top: brute(docs, items, top) for top in (3, 50)}
    assert tuples(ranking.ranked(frame(docs).repartition(3), asked)) == want[50]
    assert tuples(ranking.ranked(frame(docs), asked, top=3, block_bytes=200)) == want[3]


def searched(docs, items, top, shard, chunk, monkeypatch):
    import pyarrow as pa

    from nightledger.llm.words import ALNUM, Words, buffers

    monkeypatch.setattr(ranking, "SHARD_ROWS", shard)
    monkeypatch.setattr(ranking, "CHUNK_ITEMS", chunk)
    block = ranking.Block([i for i, _ in items], [t for _, t in items])
    words = Words(*buffers(pa.array([t for _, t in docs])), ALNUM, lower=True)
    holding = np.bincount(block.entries(words)[1], minlength=block.terms)
    n_docs = int((words.counts > 0).sum())
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * holding + 1))).astype(np.int64)
    searcher = ranking.Searcher(block, weights, n_docs, len(words), top)
    for lo in range(0, len(docs), 40):
        part = docs[lo : lo + 40]
        searcher.add(Words(*buffers(pa.array([t for _, t in part])), ALNUM, lower=True), np.array([i for i, _ in part]))
    searcher.flush()
    found = zip(block.ids, searcher.best, strict=True)
    return sorted(((i, r, d, s) for i, b in found for r, (d, s) in enumerate(zip(b.ids.tolist(), b.scores.tolist(), strict=True), 1)), key=repr), searcher


def test_subtrees_are_pruned_without_loss(monkeypatch):
    """Documents of four vocabularies: an item looks at those of its own."""
    rng = random.Random(4)
    docs = [(i, " ".join(f"{'abcd'[i % 4]}{int(rng.paretovariate(0.6))}" for _ in range(30))) for i in range(1200)]
    items = [(i, " ".join(docs[i][1].split()[:9])) for i in range(24)]
    got, searcher = searched(docs, items, 5, 400, 7, monkeypatch)
    assert got == brute(docs, items, 5)
    assert searcher.scored < 0.5 * len(docs) * len(items)


def test_bounds_hold_at_every_node():
    rng = np.random.default_rng(5)
    for _ in range(20):
        rows, terms = 200, 40
        size = rng.integers(1, 12, rows)
        term = np.concatenate([np.sort(rng.choice(terms, s, False)) for s in size])
        value = rng.integers(1, 1_000_000, len(term))
        weights = rng.integers(0, 9000, terms)
        vectors = ranking.Vectors(np.arange(rows), size, term, value, value * np.sqrt(weights[term]))
        tree = ranking.Tree(vectors, terms)
        asked = np.where(rng.random((15, terms)) < 0.3, weights, 0)
        bounds = tree.bounds(asked)

        def most(node, tree=tree, asked=asked):
            if tree.leaf[node] is not None:
                own = tree.leaf[node]
                return np.array([own.sums(own.value * q[own.term]).max() for q in asked])
            return np.maximum(*[most(child) for child in tree.children[node]])

        for node in range(len(tree.leaf)):
            assert (most(node) <= bounds[node]).all()


def test_long_corpora_do_not_overflow():
    searcher = ranking.Searcher(ranking.Block([1], ["a"]), np.array([5]), 10**12, 10**13, 3)
    counts = np.array([0, 10**6, 10**8])
    assert searcher._relative(counts).tolist() == [50 * int(n) * 10**12 // 10**13 for n in counts]


def test_empty_tables_and_other_columns(spark, frame):
    docs = frame([(1, "some words"), (2, "words")]).toDF("doc_id", "text", "rank", "score", "a.b")
    asked = spark.createDataFrame([(9, "words", 1)], ITEMS + ", doc_id int")
    assert [r[:3] for r in tuples(ranking.ranked(docs, asked))] == [(9, 1, 2), (9, 2, 1)]
    assert ranking.ranked(frame([]), asked).count() == 0
    assert ranking.ranked(docs, asked.where("item_id < 0")).count() == 0
    named = spark.createDataFrame([("x", "words")], "item_id string, text string")
    assert [r[:3] for r in tuples(ranking.ranked(docs, named))] == [("x", 1, 2), ("x", 2, 1)]
