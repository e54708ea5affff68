"""The query against its DuckDB twin, raked marginals, and odd inputs."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle import compare, duck
from tillbook.llm import mixture


def test_oracle(spark):
    ok, msg = compare(spark, "op3_mixture", mixture.query, mixture.oracle(), SF_SMALL, duck(SF_SMALL))
    assert ok, msg


def test_expected_sample_has_the_target_marginals(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    given = {"lang": {"en": 0.4, "de": 0.3}}
    rows = mixture.mix(docs, given=given, rounds=30).withColumn("expected", F.col("n_tokens") * F.col("probability"))
    total = rows.agg(F.sum("expected")).first()[0]
    by = {r.lang: r.s / total for r in rows.groupBy("lang").agg(F.sum("expected").alias("s")).collect()}
    assert by["en"] == pytest.approx(0.4, abs=1e-3) and by["de"] == pytest.approx(0.3, abs=1e-3)
    assert rows.agg(F.max("probability")).first()[0] == 1.0


def test_a_tiny_source_does_not_empty_the_others(spark):
    """One short document of a new source and language changes the kept tokens by less than a hundredth."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source", "lang")
    tiny = spark.createDataFrame([(10**9, "new words " * 50, "tiny", "xx")], docs.schema)

    def kept(rows):
        rows = mixture.mix(rows).cache()
        total, expected = rows.agg(F.sum("n_tokens"), F.sum(F.col("n_tokens") * F.col("probability"))).first()
        return expected / total, {r.source: r.probability for r in rows.where("source = 'tiny'").collect()}

    before, _ = kept(docs)
    after, odds = kept(docs.unionByName(tiny))
    assert before == pytest.approx(mixture.SHARE, abs=1e-2) and abs(after - before) < 1e-2
    assert odds["tiny"] > 0.9


def test_full_cells_leave_the_rest_to_others(spark):
    """A cell at its bound is kept whole, and the marginals that can be met are met."""
    cells = [("a", "en", "prose", 100), ("a", "de", "prose", 900), ("b", "en", "prose", 500), ("b", "de", "prose", 500)]
    rows = spark.createDataFrame(cells, "source string, lang string, topic string, n_tokens long")
    odds = mixture.calibrated(rows, given={"lang": {"en": 0.6}, "source": {"a": 0.5}}, share=0.4, rounds=60).collect()
    p = {(r.source, r.lang): r.probability for r in odds}
    assert p["a", "en"] == pytest.approx(1.0) and max(p.values()) <= 1
    kept = {(s, l): p[s, l] * n for s, l, _, n in cells}
    assert sum(kept.values()) == pytest.approx(800, rel=1e-2)
    assert kept["a", "en"] + kept["b", "en"] == pytest.approx(480, rel=1e-2)


def test_broadcast_limit_does_not_change_the_result(spark, monkeypatch):
    want = sorted(map(tuple, mixture.query(spark, SF_SMALL).collect()))
    monkeypatch.setattr(mixture, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, mixture.query(spark, SF_SMALL).collect())) == want


def test_odd_inputs(spark):
    schema = "doc_id long, text string, source string, lang string, probability int, weight int"
    rows = [(1, None, "a", "en"), (2, "", "a", None), (3, "x " * 50_000, None, "en"), (None, "p | q", "b", "en"),
            (4, "same", "a", "en"), (4, "same", "a", "en")]
    got = mixture.mix(spark.createDataFrame([(*r, 0, 0) for r in rows], schema)).collect()
    assert len(got) == len(rows) and all(0 <= r.probability <= 1 for r in got)
    assert len({(r.probability, r.sampled) for r in got if r.doc_id == 4}) == 1
    assert {r.doc_id: r.n_tokens for r in got} == {1: 0, 2: 0, 3: 50_000, None: 3, 4: 1}


def test_empty_table(spark):
    assert mixture.mix(spark.createDataFrame([], "doc_id long, text string, source string, lang string")).count() == 0


def test_all_texts_empty(spark):
    df = spark.createDataFrame([(1, "", "a", "en"), (2, None, "b", "en")], "doc_id long, text string, source string, lang string")
    assert mixture.mix(df).count() == 2
