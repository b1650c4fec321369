"""Source mixing, licence scan and captures: results, and no Python in their plans."""

import hashlib
import random
import re

import pytest
from helpers import frame, prose, tuples  # noqa: F401

from nightledger.llm import captures, licences, mixing, queries

PYTHON = ("EvalPython", "InPandas", "InArrow", "Cartesian", "NestedLoop")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def targets(sizes):
    """Targets by sharing the excess again and again; sizes by source."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, out, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        for s in over or open_:
            out[s] = 2 * sizes[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def mixed_rows():
    sources = [None, "b", "a", "é", "Z", "tiny", "empty"]
    rows = [(i, " ".join(prose(i, 1 + i * 7 % 90)), sources[(i * i) % 5] if i % 2 else "b") for i in range(300)]
    rows += [(900, "x y", "tiny"), (901, None, "empty"), (902, "", "empty"), (903, None, "a"), (None, "one two three", "a")]
    return rows + [(904, "twice the same row", "a")] * 2


def test_mix(spark, frame):
    rows = mixed_rows()
    got = mixing.mix(frame(rows).repartition(3)).collect()
    assert len(got) == len(rows)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    total = {}
    for i, _, s in rows:
        total[s] = total.get(s, 0) + size[i]
    want, source, taken = targets(total), {i: s for i, _, s in rows}, {}
    for r in got:
        s = source[r.doc_id]
        assert (r["size"], r.source_size) == (size[r.doc_id], total[s])
        assert r.target == pytest.approx(want[s], rel=1e-9)
        assert r.copies in (0, 1, 2) and r.taken == r.copies * r["size"]
        assert int(want[s] / total[s]) <= r.copies <= int(want[s] / total[s]) + 1 if total[s] else True
        taken[s] = taken.get(s, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(size[i] for i, _, x in rows if x == s) / 2 + 1e-6


def test_mix_does_not_depend_on_storage(spark, frame):
    rows = mixed_rows()
    one = tuples(mixing.mix(frame(rows).repartition(1)))
    assert one == tuples(mixing.mix(frame(rows[::-1]).repartition(7)))


def test_mix_groups_form_a_tree(spark, frame, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 4)
    got = mixing.mix(frame([(i, " ".join("x" * (i % 9 + 1)), "a" if i % 3 else "b") for i in range(400)]))
    by = got.groupBy("target").agg({"taken": "sum"}).collect()
    assert all(abs(r[0] - r[1]) <= 4.5 for r in by)


def test_mixed_documents(spark, frame):
    docs = frame(mixed_rows()).withColumnRenamed("lang", "taken")
    out = mixing.mixed_documents(docs)
    assert out.columns == ["doc_id", "text", "source", "n_chars", "copies", "taken"]
    want = sorted(((r.doc_id, r.copies, r.taken) for r in mixing.mix(docs.drop("taken")).collect() if r.copies), key=repr)
    assert tuples(out, "doc_id", "copies", "taken") == want


def brute_pivot(items):
    """Words handed from one to the other, with the operator's random numbers, in its order."""
    done, last = {}, items[0]
    for new in items[1:]:
        old = last
        if not 0 < old[3] < old[2]:
            done[old[1]], last = old[3] > 0, new
            continue
        gain, give = min(old[2] - old[3], new[3]), min(old[3], new[2] - new[3])
        moved = gain if new[0] * (gain + give) < give else -give
        a, b = (*old[:3], old[3] + moved), (*new[:3], new[3] - moved)
        if abs(a[3]) < 1e-9 or abs(a[3] - a[2]) < 1e-9:
            done[a[1]], last = a[3] > 1e-9, b
        else:
            done[b[1]], last = b[3] > 1e-9, a
    if 1e-9 < last[3] < last[2] - 1e-9:
        return done, last
    return done | {last[1]: last[3] > 1e-9}, None


def test_pairs_equal_a_plain_loop(spark):
    rng = random.Random(2)
    for case in range(20):
        items = sorted((rng.random(), i, float(size), size * rng.choice([0.25, 0.5, 0.1])) for i, size in enumerate(rng.choices(range(1, 60), k=rng.randrange(1, 30))))
        df = spark.createDataFrame([(items,)], "items array<struct<u:double,id:int,size:double,mass:double>>")
        out = df.select(mixing._pair(mixing.F.col("items")).alias("o")).first().o
        done, last = brute_pivot(items)
        assert {d.id: d.take for d in out.done} == done
        assert (out.last is None) == (last is None)
        if last:
            assert (out.last.id, out.last.mass) == (last[1], pytest.approx(last[3]))


def test_repeated_rows_are_rounded_as_one_class(spark, frame, monkeypatch):
    monkeypatch.setattr(mixing, "PORTION", 100)
    rows = [(1, "a b c", "s")] * 1501 + [(2, "a b", "s")] * 7 + [(i, " ".join(prose(i, i % 20)), "t") for i in range(3, 90)]
    got = mixing.mix(frame(rows)).collect()
    assert len(got) == len(rows)
    (target,) = {r.target for r in got if r.doc_id == 1}
    taken = sum(r.taken for r in got if r.doc_id < 3)
    assert abs(taken - target) <= 1.5 + 1e-6 and len({r.copies for r in got if r.doc_id == 1}) == 2
    out = mixing.mixed_documents(frame(rows))
    want = sorted(((r.doc_id, r.copies, r.taken) for r in got if r.copies), key=repr)
    assert tuples(out, "doc_id", "copies", "taken") == want
    assert {tuple(r)[:2] for r in out.where("doc_id = 1").select("doc_id", "text").collect()} == {(1, "a b c")}


def test_mix_is_native_and_takes_empty_tables(spark, frame):
    out = mixing.mix(frame(mixed_rows()))
    assert not [p for p in PYTHON if p in plan(out)]
    assert mixing.mix(frame([])).count() == 0 and mixing.mixed_documents(frame([])).count() == 0


def brute_licence(text, least=0.8):
    lines = re.sub(licences.GAP, " ", (text or "").translate(str.maketrans(licences.UPPER, licences.LOWER))).split("\n")

    def grams(t):
        w = [x for x in re.split("[ \n]", t) if x]
        return set(zip(w[:-1], w[1:], strict=True))

    def best(g):
        scored = []
        for i, (name, t) in enumerate(sorted(licences.TEMPLATES.items())):
            own = {tuple(x.split(" ")) for x in licences.bigrams_of(t)}
            score = 2 * len(own & g) / (len(own) + len(g)) if g else 0
            scored.append((score, -i, name))
        return max(s for s in scored) if max(scored)[0] >= least else None

    found = [b for b in map(best, map(grams, lines)) if b]
    whole = best(grams("\n".join(lines))) if len(lines) > 1 else None
    top = max(found + ([whole] if whole else []), default=None)
    return (top[2], top[0], len(found)) if top else (None, 0.0, 0)


def test_licences(spark, frame):
    notices = list(licences.TEMPLATES.values())
    texts = [f"{' '.join(prose(i, 30))}\n{n.upper() if i % 2 else n}\nmore text" for i, n in enumerate(notices)]
    texts += ["Released under\nthe MIT License.", "released   under the mit licence", "Released under the MIT License!" * 3]
    texts += [None, "", "\n\n", "word", "Licensed under the Apache License, Version 2.0, as is.", notices[0] + "\n" + notices[1], "x " * 5000]
    got = licences.licence_scan(frame(list(enumerate(texts)) + [(0, texts[0])]))
    want = [(i, *brute_licence(t)) for i, t in list(enumerate(texts)) + [(0, texts[0])]]
    assert tuples(got) == sorted(want, key=repr)
    assert not [p for p in (*PYTHON, "Exchange") if p in plan(got)]
    assert licences.licence_scan(frame([])).count() == 0


def test_licences_inside_lines_and_wrapped(spark, frame):
    before, after = " ".join(prose(1, 40)), " ".join(prose(2, 40))
    notices = sorted(licences.TEMPLATES.items())
    texts = [f"{before} {n} {after}" for _, n in notices]
    for _, n in notices:
        words = n.split(" ")
        texts.append(f"{before}\n{' '.join(words[: len(words) // 2])}\n{' '.join(words[len(words) // 2 :])}\n{after}")
    whole = {name: text for name, text in licences.TEXTS if name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Unlicense")}
    texts += [f"{before}\nCopyright 2020 A. Author\n\n{re.sub('(.{60}[^ ]*) ', chr(92) + '1' + chr(10), t)}\n{after}" for t in whole.values()]
    texts += [f"{before} {notices[0][1]} {before} {notices[7][1]} {after} {notices[7][1]}", f"{before} the {after}", None, "", "word"]
    got = {r.doc_id: (r.licence, r.score, r.n_notices) for r in licences.licence_notices(frame(list(enumerate(texts)))).collect()}
    want = [(name, 1.0, 1) for name, _ in notices] * 2 + [(name, 1.0, 1) for name in whole]
    want += [("Apache-2.0", 1.0, 3)] + [(None, 0.0, 0)] * 4
    assert [got[i] for i in range(len(texts))] == want


def brute_windows(text, templates, least=0.8):
    words = re.sub(licences.GAP, " ", (text or "").translate(str.maketrans(licences.UPPER, licences.LOWER))).split()
    grams, scored = list(zip(words[:-1], words[1:], strict=True)), []
    for i, (name, t) in enumerate(sorted(templates)):
        own = {tuple(x.split(" ")) for x in licences.bigrams_of(t)}
        for size in range(1, int(len(own) * (2 - least) / least + 1e-9) + 1):
            for lo in range(len(grams) - size + 1):
                window = set(grams[lo : lo + size])
                scored.append((2 * len(own & window) / (len(own) + len(window)), -i, name))
    top = max(scored, default=(0,))
    return (top[2], top[0]) if top[0] >= least else (None, 0.0)


def test_licence_windows_equal_brute_force(spark, frame):
    rng = random.Random(3)
    templates = [("a", "a b c d e f"), ("b", "a b c x y z a b"), ("a", "q r s"), ("c", "d e f a b c d e x x x")]
    letters = "abcdefxyz"
    texts = [" ".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(150)]
    for i in range(150):
        words = rng.choice(templates)[1].split(" ") * rng.randrange(1, 3)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(letters)
        texts.append(" p\n".join(["n n", rng.choice([" ", "\n"]).join(words), "m"]))
    got = licences.licence_notices(frame(list(enumerate(texts))), templates)
    assert tuples(got, "doc_id", "licence", "score") == sorted(((i, *brute_windows(t, templates)) for i, t in enumerate(texts)), key=repr)
    assert not [p for p in (*PYTHON, "Exchange") if p in plan(got)]


def test_licence_query_finds_notices_inside_lines(spark, tmp_path, frame):
    text = f"{' '.join(prose(1, 30))} Released under the MIT License. See LICENSE for details."
    frame([(1, text)]).write.parquet(str(tmp_path / "documents.parquet"))
    (row,) = queries.QUERIES["op4_licence_scan"](spark, str(tmp_path)).collect()
    assert (row.licence, row.score, row.n_notices) == ("MIT", 1.0, 1)


CAPTURES = "record_id long, url string, captured_at long, kind string, etag string, last_modified string, headers map<string,string>, payload string"


def test_revisits(spark, frame):
    h = {"etag": '"a"', "content-type": "text/html", "date": "1"}
    rows = [
        (1, "http://www.A.com:80/x/?b=2&utm_source=q&a=1#f", 10, "response", '"a"', "m1", h, "first"),
        (2, "https://a.com/x?a=1&b=2", 20, "revisit", 'W/"a"', None, {"date": "2", "content-type": "none"}, None),
        (3, "https://a.com/x?a=1&b=2", 30, "response", '"b"', None, h, "second"),
        (4, "https://a.com/x?a=1&b=2", 30, "revisit", '"b"', None, None, None),
        (5, "https://a.com/x?a=1&b=2", 40, "revisit", '"a"', None, {"k": "v"}, None),
        (6, "https://a.com/x?a=1&b=2", 5, "revisit", '"a"', None, None, None),
        (7, "https://b.com", 50, "response", None, "m", None, "third"),
        (8, "https://b.com/", 60, "revisit", None, "m", {"date": "3"}, None),
        (9, "https://b.com/", 61, "revisit", '"z"', None, None, None),
        (10, None, 61, "revisit", '"z"', None, None, None),
        (11, "https://b.com/", 62, "request", None, None, None, None),
        (8, "https://b.com/", 60, "revisit", None, "m", {"date": "3"}, None),
        (12, "not a url", 1, "response", None, "m", None, ""),
        (13, "not a url", 2, "revisit", None, "m", None, None),
    ]
    log = spark.createDataFrame(rows, CAPTURES).withColumn("status", mixing.F.lit("clash"))
    out = captures.resolve_revisits(log)
    got = sorted(((r.record_id, r.response_id, r.status, r.payload) for r in out.collect()), key=repr)
    want = [
        (2, 1, "resolved", "first"), (4, 3, "resolved", "second"), (5, 3, "changed", None), (6, None, "missing", None),
        (8, 7, "resolved", "third"), (8, 7, "resolved", "third"), (9, 7, "unchecked", None), (10, None, "missing", None),
        (13, 12, "resolved", ""),
    ]
    assert got == sorted(want, key=repr)
    headers = {r.record_id: r.headers for r in out.collect()}
    assert headers[2] == {"etag": '"a"', "content-type": "text/html", "date": "2"}
    assert headers[5] == {"k": "v"} and headers[4] == h
    assert captures.resolve_revisits(spark.createDataFrame([], CAPTURES)).count() == 0


def test_clashing_responses_are_chosen_alike(spark):
    one = (1, "http://a/", 1, "response", "e", None, {"x": "1"}, "first")
    two = (1, "http://a/", 1, "response", "e", None, {"x": "2"}, "second")
    ask = (2, "http://a/", 2, "revisit", "e", None, None, None)
    kept = [
        captures.resolve_revisits(spark.createDataFrame(rows, CAPTURES).repartition(n)).first()
        for rows, n in (([one, two, ask], 1), ([two, ask, one], 3), ([two, one, one, ask], 2))
    ]
    assert len({(r.payload, r.headers["x"]) for r in kept}) == 1


def test_hot_url_is_carried_over_ranges(spark):
    rows = [(i, "https://hot.example/", i, "response" if i % 50 == 0 else "revisit", '"e"', None, None, "p") for i in range(3000)]
    log = spark.createDataFrame(rows, CAPTURES).repartition(8)
    got = {r.record_id: r.response_id for r in captures.resolve_revisits(log).collect()}
    assert got == {i: i - i % 50 for i in range(3000) if i % 50}


def test_revisit_query_hands_over_pages(spark, tmp_path, monkeypatch):
    pages = [(i, f"http://a.example/{i}", f"<p>page {i}</p>") for i in range(1, 13)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    seen, resolve = set(), captures.resolve_revisits

    def watched(records):
        seen.update(r.payload for r in records.where("kind = 'response'").collect())
        return resolve(records)

    monkeypatch.setattr(captures, "resolve_revisits", watched)
    got = queries.QUERIES["op9_revisits"](spark, str(tmp_path)).where("status = 'resolved'").collect()
    assert seen == {html for _, _, html in pages}
    digest = {i * 4: hashlib.sha256(html.encode()).hexdigest() for i, _, html in pages}
    assert got and all(r.payload == digest[r.response_id] for r in got)
