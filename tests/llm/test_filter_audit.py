"""The query against its DuckDB twin, the audit against a walk through every order, and odd rows."""

import itertools
import random
import re

import numpy as np
import pytest

from conftest import SF_SMALL
from oracle import compare, duck
from tillbook.llm import filter_audit as fa

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_oracle(spark):
    ok, msg = compare(spark, "op13_filter_audit", fa.query, fa.oracle(), SF_SMALL, duck(SF_SMALL))
    assert ok, msg


def walk(docs, labels):
    """Apply each order to each document."""
    marks = {}
    for doc_id, quality, toxic in labels:
        g, t = marks.get(doc_id, (False, False))
        marks[doc_id] = (g or quality == 1, t or toxic == 1)
    flagged = []
    for doc_id, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = doc_id is not None and any((t or "") == text and i is not None and i < doc_id for i, t, _ in docs)
        fails = {n for n, bad in zip("ABCDE", (len(words) < 50, 100 * len(set(words)) < 65 * len(words),
                                               100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                                               bool(re.search(r"[#$%&*|]", text)), copy), strict=True) if bad}
        flagged.append((source or "", fails, *(marks.get(doc_id, (False, False)) if doc_id is not None else (False, False))))
    out = []
    for part in {f[0] for f in flagged}:
        own = [f for f in flagged if f[0] == part]
        rows = []
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, n in enumerate(order, 1):
                gone = [bool(f[1] & set(order[:step - 1])) for f in own]
                taken = [f for f, g in zip(own, gone, strict=True) if n in f[1] and not g]
                rows.append((part, order, step, sum(not g for g in gone) - len(taken), len(taken),
                             sum(n in f[1] and g for f, g in zip(own, gone, strict=True)), sum(f[1] == {n} for f in own),
                             sum(f[2] for f in taken), sum(f[3] for f in taken)))
        share = {n: sum(r[4] for r in rows if r[1][r[2] - 1] == n) for n in "ABCDE"}
        out += [(*r, share[r[1][r[2] - 1]]) for r in rows]
    return sorted(out)


def result(spark, docs, labels):
    d = spark.createDataFrame([(*r, 1, True) for r in docs], "doc_id long, text string, source string, row int, good boolean")
    l = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    rows = fa.marked(fa.failures(d.repartition(3)), l)
    return sorted(tuple(r[c] for c in COLUMNS) for r in fa.audit(rows).collect())


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(1, None, "a"), (2, "", "a"), (3, long, None), (4, long, ""), (4, long, ""), (5, long + " #", "b"),
            (None, long, "b"), (6, "ABC " * 70, "b"), (7, "a\tb\nc\x0bd\x0ce\rf", "b"), (8, "a b " * 200_000, "b"),
            (9, "é" * 40 + "|", "c"), (10, " ".join(f"v{i}" for i in range(80)), "clean"), (6, "ABC " * 70, "b")]
    labels = [(3, 1, 0), (3, 0, 1), (4, 1, None), (5, None, 1), (None, 1, 1), (6, 0, 0), (77, 1, 1)]
    assert result(spark, docs, labels) == walk(docs, labels)


def test_random_rows(spark):
    rnd = random.Random(3)
    words = ["The", "a", "of", "RUN", "x$", "red", "fox", "lies", "low", *[f"w{i}" for i in range(60)]]
    texts = [" ".join(rnd.choices(words, k=rnd.randint(0, 90))) for _ in range(40)]
    docs = [(i, rnd.choice(texts), rnd.choice(["a", "a", "a", "b", None])) for i in range(150)]
    labels = [(i, rnd.randint(0, 1), rnd.randint(0, 1)) for i in range(0, 150, 2)]
    assert result(spark, docs, labels) == walk(docs, labels)


def test_ranges_add_up(spark, monkeypatch):
    """Small ranges give the same sums: one part over many posting lists."""
    monkeypatch.setattr(fa, "RANGE_BITS", 2)
    docs = [(i, "x " * (i % 70) + ("#" if i % 3 else ""), "a") for i in range(60)]
    assert result(spark, docs, [(5, 1, 1)]) == walk(docs, [(5, 1, 1)])


def test_empty_tables(spark):
    assert result(spark, [], []) == []
    assert result(spark, [(1, "one", "a")], []) == walk([(1, "one", "a")], [])


@pytest.mark.parametrize("sizes", [(0, 5), (5, 0), (3, 400), (400, 3), (200, 190), (1, 1)])
def test_lists(sizes):
    rnd = np.random.default_rng(1)
    a, b = (np.sort(rnd.choice(600, n, replace=False)).astype(np.int64) for n in sizes)
    new = fa.added(a, b)
    assert new.tolist() == sorted(set(a.tolist()) - set(b.tolist()))
    assert fa.merged(b, new).tolist() == sorted(set(a.tolist()) | set(b.tolist()))
