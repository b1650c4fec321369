import hashlib
import re
import zlib

import pytest
from helpers import frame, prose, tuples  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from nightledger.llm import periods, queries


def brute(words, least, times):
    """Longest stretches for every period by comparing words; of equal stretches the smallest period."""
    found, n = {}, len(words)
    for period in range(1, n // times + 1):
        at = 0
        while at + period < n:
            start = at
            while at + period < n and words[at] == words[at + period]:
                at += 1
            length = at - start + period
            if at > start and length >= max(least, times * period):
                found.setdefault((start, length), period)
            at += 1
    return sorted((s, n, p) for (s, n), p in found.items())


repeats = st.lists(st.tuples(st.lists(st.integers(0, 2), max_size=6), st.integers(1, 6)), max_size=6)


@settings(max_examples=400, deadline=None)
@given(repeats, st.sampled_from([(24, 3), (6, 2), (9, 3), (4, 4), (2, 2)]))
def test_runs_equal_brute_force(parts, sizes):
    words = [w for part, times in parts for w in part * times]
    assert periods.runs_of(words, *sizes) == brute(words, *sizes)


def test_states_of_a_prefix_have_its_length():
    link, size, ends = periods.automaton(list("abcbcabcbc"))
    assert [size[e] for e in ends] == list(range(1, 11))
    assert all(size[link[s]] < size[s] for s in range(1, len(size)))


def texts():
    line = prose(5, 9)
    rows = [None, "", " \n\t", "one", "x " * 5000, " ".join(line * 4), " ".join(prose(1, 50) + line * 3 + line[:4] + prose(2, 30))]
    rows += [" ".join(prose(3, 400) * 3), "\n".join([" ".join(line)] * 3) + " ", " ".join(prose(4, 3000))]
    rows += [" ".join(line * 3 + prose(6, 40) + line * 3 + ["a", "b"] * 14 + ["b"] * 30)]
    return rows


def expected(text, least=24, times=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = brute(words, least, times)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("sizes", [(24, 3), (5, 2)])
def test_documents_equal_brute_force(spark, frame, sizes):
    rows = [(i, t) for i, t in enumerate(texts())] + [(6, texts()[6]), (6, texts()[6]), (None, texts()[5])]
    got = periods.periodic_runs(frame(rows).repartition(3), *sizes).collect()
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=repr)
    assert found == sorted(((i, *expected(t, *sizes)) for i, t in rows), key=repr)


def test_names_and_empty_tables(spark, frame):
    docs = frame([(1, "a b " * 20)]).toDF("row", "text", "runs", "a.b", "N_Words")
    out = periods.periodic_runs(docs)
    assert out.columns == ["row", "text", "a.b", "n_words", "runs", "collapsed"]
    (row,) = out.collect()
    assert (row[0], row[2], row[3], row[5]) == (1, "s", 40, "a b")
    assert periods.periodic_runs(frame([])).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        periods.periodic_runs(docs, 10, 1)


def test_query_equals_brute_force(spark, frame, tmp_path):
    rows = [(i, " ".join(prose(i, 17 * i % 400))) for i in range(1, 160)] + list(enumerate(texts(), 200)) + [(None, texts()[5])]
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    want = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        _, runs, collapsed = expected(" ".join(words))
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed)]
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha))
    assert tuples(queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path))) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 12
