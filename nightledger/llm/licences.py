"""Licence notices found by the Dice coefficient over word bigrams, on DataFrame functions only.

``licence_notices`` compares every window of words, across line ends too, to the templates and to licence texts.
``licence_scan`` compares single lines and the whole document only. Of a text with n distinct bigrams only templates are
compared whose own number allows the wanted coefficient.

A window with the coefficient c of a template of n bigrams shares at least n * c / (2 - c) of them. So a document
is looked at only for templates of which it has as many, and there only windows that begin and end with a bigram of
the template: others have a shorter window inside that is more alike.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.llm.licence_texts import TEXTS

# Wording of licence notices in common use.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the 3-Clause BSD License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
LEAST = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing; line ends stay


def bigrams_of(text: str) -> list[str]:
    """Distinct bigrams of a template."""
    words = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ", text.translate(str.maketrans(UPPER, LOWER))).split(" ")
    words = [w for w in words if w]
    return sorted({f"{a} {b}" for a, b in zip(words[:-1], words[1:], strict=True)})


def _pairs(line: Column) -> Column:
    words = F.filter(F.split(line, "[ \n]"), lambda w: w != "")
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.filter(pairs, lambda p: p.isNotNull())


def _bigrams(line: Column) -> Column:
    return F.array_distinct(_pairs(line))


def _plain() -> Column:
    return F.regexp_replace(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), GAP, " ")


def _literal(named: list[tuple[str, str]]) -> Column:
    """Order, name and bigrams of the templates that have bigrams."""
    table = [(-i, name, bigrams_of(text)) for i, (name, text) in enumerate(named)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("order"), F.lit(name).alias("name"), F.split(F.lit("\n".join(grams)), "\n").alias("grams"))
            for i, name, grams in table
            if grams
        ]
    )


def _best(templates: Column, grams: Column, least: float) -> Column:
    """The template most like the distinct bigrams ``grams``, if its coefficient is at least ``least``."""
    n = F.size(grams)
    fits = F.filter(
        templates,
        lambda t: (F.size(t.grams) * F.lit(2 - least) >= n * F.lit(least))
        & (n * F.lit(2 - least) >= F.size(t.grams) * F.lit(least)),
    )
    score = F.transform(
        fits,
        lambda t: F.struct(
            (2 * F.size(F.array_intersect(t.grams, grams)) / (n + F.size(t.grams))).alias("score"),
            t.order.alias("order"),
            t["name"].alias("name"),
        ),
    )
    return F.array_max(F.filter(score, lambda s: s.score >= least))


def licence_scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, licence, score and n_notices of every row of ``docs``, by lines.

    ``licence`` is the template most like any line or the whole text, if its coefficient is at least ``least``;
    of equals the first by name. ``n_notices`` counts the lines that reach it. Null and empty texts, and texts of one
    word, have no notice: licence null, score 0. Columns other than doc_id and text are ignored. A notice that is part of
    a line or wrapped is for ``licence_notices``.
    """
    literal = _literal(sorted((templates or TEMPLATES).items()))
    plain = _plain()
    lines = F.split(plain, "\n")
    work = docs.select("doc_id", lines.alias("lines"), plain.alias("whole"))

    def best(grams: Column) -> Column:
        return _best(literal, grams, least)

    found = F.filter(F.transform(F.transform("lines", _bigrams), best), lambda s: s.isNotNull())
    whole = F.when(F.size("lines") > 1, F.transform(F.array(_bigrams(F.col("whole"))), best)[0])
    work = work.select("doc_id", found.alias("found"), whole.alias("whole"))
    top = F.array_max(F.concat("found", F.array("whole")))
    return work.select(
        "doc_id",
        top["name"].alias("licence"),
        F.coalesce(top["score"], F.lit(0.0)).alias("score"),
        F.size("found").cast("long").alias("n_notices"),
    )


def licence_notices(docs: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, licence, score and n_notices of every row of ``docs``, by windows of words.

    ``licence`` is the template most like any window, line or the whole text, if its coefficient is at least ``least``;
    of equals the first by name. Windows run across line ends and have as many bigrams as the coefficient allows.
    ``templates`` are pairs of a name and a text, several of one name if wanted; without, ``TEMPLATES`` and the licence
    texts. ``n_notices`` counts the windows that reach ``least`` and share no word with a better one (of equals the
    longer, then the earlier), or the lines that reach it if they are more. Null and empty texts, and texts of one word, have no
    notice: licence null, score 0. Columns other than doc_id and text are ignored.
    """
    named = sorted(templates if templates is not None else [*TEMPLATES.items(), *TEXTS])
    literal = _literal(named)
    every = F.split(F.lit("\n".join(sorted({g for _, text in named for g in bigrams_of(text)}))), "\n")

    def needed(t: Column) -> Column:
        return F.ceil(F.size(t.grams) * F.lit(least) / F.lit(2 - least) - 1e-9).cast("int")

    work = docs.select("doc_id", _plain().alias("plain"))
    work = work.select("doc_id", "plain", _pairs(F.col("plain")).alias("pairs"))
    work = work.select("*", F.array_intersect("pairs", every).alias("known"))
    able = F.filter(literal, lambda t: F.size(F.array_intersect("known", t.grams)) >= needed(t))
    work = work.select("doc_id", "plain", "pairs", F.when(F.size("known") > 0, able).alias("able"))

    def places(t: Column) -> Column:
        at = F.sequence(F.lit(1), F.size("pairs"))
        hits = F.filter(at, lambda p: F.array_contains(t.grams, F.get("pairs", p - 1)))
        return F.struct(t.order.alias("order"), t["name"].alias("name"), t.grams.alias("grams"), hits.alias("hits"))

    some = F.size("able") > 0
    work = work.select("*", F.when(some, F.transform("able", places)).alias("marked"))

    def window(t: Column, lo: Column, hi: Column) -> Column:
        own = F.slice("pairs", lo, hi - lo + 1)
        score = 2 * F.size(F.array_intersect(t.grams, own)) / (F.size(F.array_distinct(own)) + F.size(t.grams))
        size = (hi - lo + 1).alias("size")
        return F.struct(score.alias("score"), size, (-lo).alias("before"), t.order.alias("order"), t["name"].alias("name"))

    def windows(t: Column) -> Column:
        """The best window from each bigram of the template."""
        most = F.floor(F.size(t.grams) * F.lit(2 - least) / F.lit(least) + 1e-9).cast("int")

        def from_place(lo: Column, i: Column) -> Column:
            ends = F.filter(F.slice(t.hits, i + needed(t), most - needed(t) + 1), lambda hi: hi - lo < most)
            return F.array_max(F.transform(ends, lambda hi: window(t, lo, hi)))

        return F.filter(F.transform(t.hits, from_place), lambda w: w.score >= least)

    def apart(chosen: Column, w: Column) -> Column:
        lo, hi = -w.before, w["size"] - w.before  # words of the window
        meets = F.exists(chosen, lambda c: (c.lo <= hi) & (lo <= c.hi))
        return F.when(meets, chosen).otherwise(F.concat(chosen, F.array(F.struct(lo.alias("lo"), hi.alias("hi")))))

    lines = F.transform(F.split("plain", "\n"), lambda x: _best(F.col("able"), _bigrams(x), least))
    whole = _best(F.col("able"), F.array_distinct("pairs"), least)
    work = work.select(
        "doc_id",
        F.when(some, F.flatten(F.transform("marked", windows))).alias("windows"),
        F.when(some, F.filter(lines, lambda s: s.isNotNull())).alias("lines"),
        F.when(some, whole).alias("whole"),
    )
    plain = F.transform("windows", lambda w: F.struct(w.score.alias("score"), w.order.alias("order"), w["name"].alias("name")))
    top = F.array_max(F.concat(plain, "lines", F.array("whole")))
    none = F.array().cast("array<struct<lo:int,hi:int>>")
    apart_ = F.size(F.aggregate(F.sort_array("windows", asc=False), none, apart))
    work = work.select("doc_id", top.alias("top"), F.greatest(apart_, F.size("lines")).alias("n"))
    return work.select(
        "doc_id",
        F.col("top")["name"].alias("licence"),
        F.coalesce(F.col("top")["score"], F.lit(0.0)).alias("score"),
        F.greatest(F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("n_notices"),
    )
