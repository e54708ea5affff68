"""The query against its DuckDB twin, a plain version with every template, and odd inputs."""

import re
from collections import Counter

from conftest import SF_MID
from oracle import compare, duck
from tillbook.llm import licences


def test_oracle(spark):
    ok, msg = compare(spark, "op5_licences", licences.query, licences.oracle(), SF_MID, duck(SF_MID))
    assert ok, msg


def plain(text, threshold=0.8):
    """{licence: (dice, n_segments)} by comparing every segment with every template."""
    norm = lambda s: " ".join(re.findall(r"[^\W_]+", s.lower()))
    segments = {norm(s) for s in (*text.split("\n"), *re.split(r"\n(?:[^\w\n]*\n)+", text), text)} - {""}
    out = {}
    for name, template in licences.TEMPLATES:
        a = licences.template_bigrams(template)
        scores = []
        for s in segments:
            words = s.split()
            b = Counter(words if len(words) == 1 else [f"{x} {y}" for x, y in zip(words, words[1:], strict=False)])
            scores.append(round(2 * (a & b).total() / (a.total() + b.total()), 9))
        hits = [x for x in scores if x >= threshold]
        if hits:
            out[name] = (max(hits), len(hits))
    return out


TEXTS = ["", "All rights reserved.", "all RIGHTS — reserved!!\nAll rights reserved", "Some prose.\nLicensed under CC BY-NC 4.0.\nMore prose.",
         "This work is licensed\nunder the GNU General\nPublic License, version 3.\n\nNext paragraph of prose that is long enough",
         "Licensed under the Apache License, Version 2.0\n \n.Released under the new MIT license.", "the the the the the", "rights", "rights reserved",
         "This Source Code Form is subject to terms of the Mozilla Public License v. 2.0", "é ü\n\nLicensed under CC BY 4.0",
         "words " * 30_000 + "\nAll rights reserved.\n" + "words " * 30_000]


def test_plain_version(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, licence string")
    got = {}
    for r in licences.scan(df).collect():
        got.setdefault(r.doc_id, {})[r.licence] = (r.dice, r.n_segments)
    assert got == {i: w for i, t in enumerate(TEXTS) if (w := plain(t))}


def test_nulls_and_repeats(spark):
    rows = [(None, TEXTS[1]), (1, None), (2, TEXTS[1]), (2, TEXTS[1])]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.licence, r.dice) for r in got) == [(k, "All-rights-reserved", 1.0) for k in (0, 2, 2)]


def test_empty_table(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licences.query(spark, SF_MID)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
