"""The query against its DuckDB twin, tiles and blocks of all sizes, and odd vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle import compare, duck
from tillbook.llm import topk


def test_oracle(spark):
    ok, msg = compare(spark, "op4_topk", topk.query, topk.ORACLE, SF_SMALL, duck(SF_SMALL))
    assert ok, msg


def brute_force(rows, k, every):
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, asked = [], {}
    for i, v in usable:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for i, q in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), c) for c, v in usable if c != i and len(v) == len(q))
        out += [(i, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(("tile", "dims", "block"), [(4096, 16, 4096), (7, 3, 5), (50, 1, 2)])
def test_blocks_and_tiles(spark, tile, dims, block):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(20)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=10, tile=tile, dims=dims, query_block=block)
    assert sorted(map(tuple, got.collect())) == brute_force(rows, 10, 10)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [0.5, 0.5]),
            (6, [0.5, 0.5]), (6, [0.5, 0.5]), (7, [1.0]), (100, [1.0, 2.0]), (100, [0.0, 2.0]), (None, [9.0, 9.0]), (8, []),
            (200, [3.0]), (300, []), (9, [300000.0, -70000.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, rank int")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0).collect())) == brute_force(rows, 10, 100)


def test_large_values_stay_exact(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 2.0**-10]), (2, [2.0**20, 0.0]), (3, [2.0**20, 2.0**-9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") == 0).collect())) == brute_force(rows, 10, 100)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 100 == 0).count() == 0
