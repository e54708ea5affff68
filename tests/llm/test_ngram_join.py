"""Classes and link counts against all pairs by brute force, also with tiny buckets, and odd inputs."""

import random
import re

import pytest

from conftest import SF_SMALL
from tillbook.llm import ngram_join


def shingles(text, width=5):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return frozenset(tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def brute_force(rows, threshold=0.8):
    """{doc_id: (class_id, n_links, n_copies)}"""
    sets = {d: shingles(t) for d, t in rows}
    groups = {}
    for d, s in sets.items():
        groups.setdefault(s, []).append(d)
    distinct = [s for s in groups if s]
    links = {s: set() for s in groups}
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if min(len(a), len(b)) >= threshold * max(len(a), len(b)):
                both = len(a & b)
                if both >= threshold * (len(a) + len(b) - both):
                    links[a].add(b)
                    links[b].add(a)
    name = {}
    for s in distinct:
        if s not in name:
            todo, seen = [s], {s}
            while todo:
                for x in links[todo.pop()] - seen:
                    seen.add(x)
                    todo.append(x)
            low = min(d for x in seen for d in groups[x])
            name.update(dict.fromkeys(seen, low))
    return {d: (name[s], len(links[s]), len(groups[s]) - 1) if s else (d, 0, 0) for d, s in sets.items()}


def found(df):
    return {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in df.collect()}


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_force(rows)
    assert any(v[1] for v in expected.values()) and any(v[2] for v in expected.values())
    assert found(ngram_join.query(spark, SF_SMALL)) == expected


def near_copies(n, seed=1):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(120)]
    out = []
    for k in range(n):
        words = list(base)
        for _ in range(k % 4):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("bucket", "depth"), [(8, 1), (8, 2), (4, 3), (256, 3)])
def test_large_groups_are_split_without_loss(spark, bucket, depth):
    texts = near_copies(60) + near_copies(40, seed=2) + [f"only one text number {k} of its own kind" for k in range(20)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(ngram_join.join(df, bucket=bucket, depth=depth)) == brute_force(rows)


def test_odd_inputs(spark):
    rows = [(1, None), (2, ""), (3, "!!!"), (4, "one two"), (5, "One, TWO."), (6, "word " * 30_000), (7, "word " * 30_001),
            (8, "a b c d e f g h i j")]
    schema = "doc_id long, text string, n int, sid string, key long, leaf int"
    df = spark.createDataFrame([(*r, 0, "", 0, 0) for r in rows], schema)
    assert found(ngram_join.join(df)) == {1: (1, 0, 0), 2: (2, 0, 0), 3: (3, 0, 0), 4: (4, 0, 1), 5: (4, 0, 1),
                                          6: (6, 0, 1), 7: (6, 0, 1), 8: (8, 0, 0)}


def test_null_and_repeated_ids(spark):
    near = near_copies(4)
    df = spark.createDataFrame([(None, near[0]), (3, near[1]), (3, near[1]), (9, "x y z")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.class_id, r.n_links, r.n_copies) for r in ngram_join.join(df).collect())
    assert got == [(0, 3, 1, 0), (3, 3, 1, 1), (3, 3, 1, 1), (9, 9, 0, 0)]


def test_empty_table(spark):
    assert ngram_join.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_reach_the_recall():
    for depth in (1, 2, 3):
        p = ngram_join.meets(depth, 0.8)
        assert (1 - p) ** ngram_join.runs_for(depth, 0.8, 0.9999) <= 1e-4
    assert ngram_join.meets(3, 0.8) < ngram_join.meets(1, 0.8) < 1
