"""Alignment against the plain recurrence, planted copies and edits, and odd inputs."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_MID
from tillbook.llm import decontaminate


def plain_score(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


words = st.lists(st.integers(0, 4), min_size=1, max_size=12)


@given(st.lists(st.tuples(words, words), min_size=1, max_size=5))
@settings(max_examples=80, deadline=None)
def test_alignment(pairs):
    arrays = [[np.array(x, np.uint64) for x in side] for side in zip(*pairs, strict=True)]
    assert decontaminate.align(*arrays).tolist() == [plain_score(a, b) for a, b in pairs]


def table(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string")


def test_copies_edits_and_clean_texts(spark):
    rnd = random.Random(3)
    vocabulary = [f"term{k}" for k in range(3000)]
    items = [" ".join(rnd.choices(vocabulary, k=30)) for _ in range(20)]
    docs, planted = [], set()
    for d in range(120):
        text = rnd.choices([*vocabulary, "the", "of", "and"], k=200)
        if d % 3 == 0:
            item = d // 3 % 20
            copy = items[item].split()
            for _ in range(d % 4):  # edited words
                copy[rnd.randrange(30)] = "edited"
            if d % 2:
                copy.insert(15, "inserted")
            text[100:100] = copy
            planted.add((d, item))
        docs.append((d, " ".join(text)))
    got = decontaminate.find(table(spark, docs, "doc_id"), table(spark, list(enumerate(items)), "item_id")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    for r in got:
        assert r.from_word <= 100 and r.to_word >= 130 and 0.5 <= r.score <= 1


def test_edited_copies_beside_a_full_one_match_brute_force(spark):
    rnd = random.Random(8)
    clean = [f"clean{k}" for k in range(400)]
    items = [[f"item{i}word{k}" for k in range(rnd.randint(16, 59))] for i in range(12)]
    items.append(["of", "the", "same", "of", "the", "same", *(f"rest{k}" for k in range(14))])
    docs = []
    for item in items:
        docs.append([*rnd.choices(clean, k=60), *item, *rnd.choices(clean, k=60)])
        for share in (0.15, 0.2, 0.25, 0.25):
            copy = [rnd.choice(clean) if rnd.random() < share else w for w in item]
            docs.append([*rnd.choices(clean, k=60), *copy, *rnd.choices(clean, k=60)])
        docs.append([*rnd.choices(clean, k=40), *item[:len(item) // 2 + 1], *rnd.choices(clean, k=40)])
        docs.append([x for k, w in enumerate(item) for x in ((w, rnd.choice(clean)) if k % 10 > 3 else (w,))])  # many insertions
    docs += [[*rnd.choices(clean, k=30), "of", "the", "same", *rnd.choices(clean, k=30)] for _ in range(40)]
    want = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            windows = {tuple(item[k:k + 3]) for k in range(len(item) - 2)}
            if any(tuple(doc[k:k + 3]) in windows for k in range(len(doc) - 2)):
                score = plain_score(item, doc) / (2 * len(item))
                if score >= 0.5:
                    want[d, i] = score
    got = decontaminate.find(table(spark, [(d, " ".join(x)) for d, x in enumerate(docs)], "doc_id"),
                             table(spark, [(i, " ".join(x)) for i, x in enumerate(items)], "item_id")).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == want
    assert len(want) > 4 * len(items)


def test_blocks_of_items_agree(spark):
    docs = [(k, f"before alpha{k} beta{k} gamma{k} delta{k} eps{k} after that") for k in range(30)]
    items = [(k, f"alpha{k} beta{k} gamma{k} delta{k} eps{k}") for k in range(30)]
    args = table(spark, docs, "doc_id"), table(spark, items, "item_id")
    whole = sorted((r.doc_id, r.item_id, r.score) for r in decontaminate.find(*args).collect())
    assert whole == [(k, k, 1.0) for k in range(30)]
    assert sorted((r.doc_id, r.item_id, r.score) for r in decontaminate.find(*args, block_words=20).collect()) == whole


def test_registered_query_finds_exact_copies(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()
    plain = {(d.doc_id, i.item_id) for d in docs for i in items if i.text and i.text in (d.text or "")}
    got = {(r.doc_id, r.item_id) for r in decontaminate.query(spark, SF_MID).collect()}
    assert plain and plain <= got
    assert len({d for d, _ in got}) < 0.1 * len(docs)


def test_odd_inputs(spark):
    leak = "one two three four five six"
    docs = [(1, None), (2, ""), (3, "no match here"), (None, f"x {leak} y"), (4, f"{leak} " * 3000), (5, leak), (5, leak)]
    items = [(7, leak), (7, leak), (8, None), (9, "too short"), (None, "null id item of several words")]
    got = decontaminate.find(table(spark, docs, "doc_id"), table(spark, items, "item_id")).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 7), (0, 7), (4, 7), (4, 7), (5, 7), (5, 7), (5, 7), (5, 7)]
    assert {r.score for r in got} == {1.0}


def test_empty_tables(spark):
    some, none = [(1, "one two three four")], []
    for docs, items in ((some, none), (none, some), (none, none)):
        assert decontaminate.find(table(spark, docs, "doc_id"), table(spark, items, "item_id")).count() == 0
