"""Held-out accuracy, the distance against a plain version, and odd inputs."""

from collections import Counter

import pyarrow as pa

from conftest import SF_MID
from tillbook.llm import language


def plain_grams(text):
    """n-grams of the blank-padded words, as strings."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    grams = Counter()
    line = f" {' '.join(words)} "
    for n in (1, 2, 3):
        for k in range(len(line) - n + 1):
            g = line[k:k + n]
            if g != " " and not (n == 3 and g[1] == " "):
                grams[g] += 1
    return grams if words else Counter()


def code(g):
    return sum(ord(c) << 21 * k for k, c in enumerate(g))


def test_grams_match_plain_count():
    texts = ["The cat, the HAT!", "", None, "x", "12 34", "  éa\nb1c ", "a  b"]
    got = language.counted_grams(pa.array(texts, pa.string()))
    for text, (codes, counts) in zip(texts, got, strict=True):
        assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == {code(g): n for g, n in plain_grams(text or "").items()}


def test_prediction_matches_plain_distance(spark):
    train = {"en": "the cat and the hat and the rat", "de": "der hund und die katze und das haus"}
    rows = spark.createDataFrame([(t, k) for k, t in train.items()], "text string, lang string")
    profiles = language.learn(rows, size=20)
    lists = {k: [code(g) for g, _ in sorted(plain_grams(t).items(), key=lambda x: (-x[1], code(x[0])))][:20]
             for k, t in train.items()}
    assert {k: v.tolist() for k, v in profiles.items()} == lists
    text = "und der rat"
    own = [code(g) for g, _ in sorted(plain_grams(text).items(), key=lambda x: (-x[1], code(x[0])))][:10]
    cost = {k: sum(min(abs(i - v.index(g)), 20) if g in v else 20 for i, g in enumerate(own)) for k, v in lists.items()}
    best = min(sorted(cost), key=cost.get)
    row = language.predict(spark.createDataFrame([(text,)], "text string"), profiles, (), 10).first()
    assert row.lang_pred == best and abs(row.score - (1 - cost[best] / (20 * len(own)))) < 1e-12


def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    got = language.query(spark, SF_MID).join(truth, "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got) > 100
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_inputs(spark):
    schema = "doc_id long, text string, lang string, lang_pred string"
    rows = [(i, "the cat and the hat", "en", None) for i in range(6)] + [
        (6, None, "en", "x"), (7, "", None, "x"), (8, "12 + 34", "en", "x"), (None, "the hat", None, "x"),
        (9, "the cat " * 40_000, None, "x"), (9, "the cat " * 40_000, None, "x")]
    got = language.classify(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {by[k].lang_pred for k in (6, 7, 8)} == {"und"} and {by[k].score for k in (6, 7, 8)} == {0.0}
    assert by[None].lang_pred == by[9].lang_pred == "en"


def test_empty_and_unlabelled_tables(spark):
    schema = "doc_id long, text string, lang string"
    assert language.classify(spark.createDataFrame([], schema)).count() == 0
    got = language.classify(spark.createDataFrame([(1, "words", None)], schema)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]
