"""The query against its DuckDB twin, trees and blocks of all sizes against brute force, and odd vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle import compare, duck
from tillbook.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_oracle(spark):
    ok, msg = compare(spark, "op11_hard_negatives", hn.query, hn.ORACLE, SF_SMALL, duck(SF_SMALL))
    assert ok, msg


def brute_force(rows, every, low=80, high=100):
    ok = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in rows
          if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, y, v in ok:
        if i % every == 0:
            asked[i] = min(asked.get(i, (y, v)), (y, v))
    out = []
    for a, (label, q) in asked.items():
        scored = [(-sum(s * t for s, t in zip(q, v, strict=True)), i, y) for i, y, v in ok if i != a and len(v) == len(q)]
        for p, pid, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fit = sorted((s, i) for s, i, y in scored if y != label and low * -p <= 100 * -s <= high * -p)[:5]
            out += [(a, pid, r, i, -p, -s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def result(spark, rows, every, parts=3, kind="double", **how):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], f"vec_id long, label int, embedding array<{kind}>, score int, dim int")
    got = hn.hard_negatives(df.repartition(parts), F.col("vec_id") % every == 0, **how)
    return sorted(tuple(r[c] for c in COLUMNS) for r in got.collect())


def clustered(n, d, centres, seed, spread=0.2):
    rnd = random.Random(seed)
    middle = [[rnd.gauss(0, 1) for _ in range(d)] for _ in range(centres)]
    return [(i, rnd.randint(0, 3), [x + rnd.gauss(0, spread) for x in rnd.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize(("tile", "block", "spread"), [(4096, 1024, 0.2), (40, 3, 0.2), (64, 8, 1.0), (1, 1, 0.2)])
def test_tiles_and_blocks(spark, tile, block, spread):
    rows = clustered(220, 6, 5, 4, spread)
    assert result(spark, rows, 10, tile_rows=tile, block=block) == brute_force(rows, 10)


def test_other_windows(spark):
    rows = clustered(150, 4, 3, 5)
    assert result(spark, rows, 10, low=50, high=120) == brute_force(rows, 10, 50, 120)


def test_odd_vectors(spark):
    rows = [(0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 2, [1.0, 1.9]), (2, 2, [1.0, 1.9]), (3, 2, [0.9, 1.9]),
            (4, None, [1.0, 2.0]), (5, 1, None), (6, 1, [None, 1.0]), (7, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]),
            (9, 2, []), (10, 1, []), (100, 1, []), (100, 2, []), (11, 2, [1.0]), (None, 2, [1.0, 1.9]), (200, 3, [0.0, 0.0]),
            (12, 3, [5.0, 5.0]), (13, 3, [0.0, 0.0]), (300, 9, [-1.0, -2.0]), (14, 9, [1.0, 2.0]), (400, 4, [2.0, 2.0])]
    assert result(spark, rows, 100) == brute_force(rows, 100)


def test_common_vector(spark):
    """A third of the rows are one vector, with many labels: ties go to the smaller ids."""
    rows = clustered(200, 5, 4, 6) + [(1000 + i, i % 3, [0.5, 0.25, 1.0, 0.0, 1.0]) for i in range(100)]
    assert result(spark, rows, 20, tile_rows=64) == brute_force(rows, 20)


def test_large_values(spark):
    """Sums beyond 2**53 stay exact, those beyond 64 bits are cut off and end nothing."""
    rows = [(0, 1, [2.0**22, 1.0]), (1, 1, [2.0**22, 2.0**-8]), (2, 2, [2.0**22, 0.0]), (3, 2, [2.0**22, 2.0**-7]), (4, 2, [2.0**21, 0.5])]
    assert result(spark, rows, 100) == brute_force(rows, 100)
    huge = [*rows, (200, 1, [1e300, 1e307]), (5, 2, [1e300, 1e300]), (6, 1, [1.7e308, 1.0])]
    got = result(spark, huge, 100)
    assert {r[0] for r in got} == {0, 200} and all(abs(r[5]) < 2**63 for r in got)


def test_empty_tables(spark):
    assert result(spark, [], 100) == []
    assert result(spark, [(1, 1, [1.0])], 100) == []
    assert result(spark, [(100, 1, [1.0])], 100) == []


def test_tree_covers():
    """Runs of children fill their parent's, centres stand apart, and every vector lies within the radius."""
    rnd = np.random.default_rng(2)
    v = np.floor(256 * np.concatenate((rnd.normal(0, 1, (300, 5)), rnd.normal(3, 0.1, (300, 5)), np.ones((50, 5)))))
    order, nodes = hn.cover_tree(v, leaf=8)
    assert sorted(order.tolist()) == list(range(len(v)))
    square = np.square(v).sum(axis=1)
    points = np.column_stack((v, np.sqrt(square.max() - square)))[order]
    for start, end, radius, child, children in nodes:
        own = points[int(start):int(end)]
        assert np.sqrt(np.square(own - own[0]).sum(axis=1)).max() <= radius + 1e-3
        if children:
            kids = nodes[int(child):int(child + children)]
            assert kids[0][0] == start and kids[-1][1] == end and (kids[1:, 0] == kids[:-1, 1]).all() and children > 1


def test_nodes_are_skipped():
    """On clustered vectors a window's search scores few of the rows."""
    rnd = np.random.default_rng(3)
    centres = rnd.normal(0, 1, (40, 16)) * 256
    v = np.floor(np.repeat(centres, 50, axis=0) + rnd.normal(0, 8, (2000, 16)))
    order, nodes = hn.cover_tree(v)
    labels = rnd.integers(0, 2, 2000)
    tile = hn.Tile(order, labels[order], v[order], nodes)
    scored = []
    for i in range(0, 2000, 100):
        goal = hn.Goal(tile, i, int(labels[i]), True, np.array([[-2**62, 2**62]]), 5)
        scored.append(tile.search(v[i], goal))
    assert np.mean(scored) < 400
