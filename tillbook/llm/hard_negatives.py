"""Hard-negative mining (11): cover trees over norm-augmented vectors, searched best first.

Candidates are dealt evenly over tiles of at most ``TILE_BYTES`` of vectors of one length. A tile gets one
more coordinate, sqrt(M - |x|^2) with M its largest squared norm, so that all its vectors lie on a sphere
and a larger inner product with a query means a smaller distance. Over them stands a cover tree: the
level below covers each node's vectors with balls of 1 / ``BASE`` of its radius, whose centres are
further apart than that; the centre of a node is a centre of the level below. Each node keeps its
true covering radius. Trees are written once, to the shared folder.

A query is a window of scores. From its distance to a centre and the radius follow the least and the
largest inner product within the node, so nodes outside all windows of a query, or below what the window
already holds, are skipped. The others are opened in the order of their largest possible product; the
vectors of leaves are scored exactly. A first search finds each anchor's best vectors of its own label,
a second one the best of other labels in the windows that these set. Queries are packed into blocks of
about ``BLOCK`` vectors, and each block meets each tile in a join on the tile's slot. Tasks return at most
k rows for a query, window and tile; neither queries nor results pass through the driver.

Scores are exact: sums run in float64 while none can reach 2**53, else in Python integers. A score that
does not fit 64 bits is returned, and compared, as the nearest one that does.

Rows with a null vec_id, label or vector, or with null, infinite or NaN components take no part. Vectors
are compared with those of their own length. An anchor is never compared with a row of its own vec_id. An
anchor id that occurs several times is asked once, by its first row in the order of label and vector;
other repeated rows count as often as they occur. Equal scores go to the smaller vec_id. An anchor
without positives, or a window without negatives, gives no rows, as do empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.llm.common import keep, release, table
from tillbook.session import configure

SCALE = 256
EVERY = 100
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # a negative's score, in per cent of the positive's
TILE_BYTES = 8 << 20  # of a tile's vectors
BLOCK = 1024
LEAF = 16
FIRST_BATCH = 16  # nodes opened at once at first
BASE = 1.4

_LIMIT = (1 << 63) - 1


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x (array of doubles) of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")))
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite
    return vectors.where(ok).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), x.cast("array<double>").alias("x"))


def _cover(points: np.ndarray, square: float, members: np.ndarray, radius: float) -> list[tuple[np.ndarray, float]]:
    """Balls of ``radius`` around members of a node, the first around its centre: (members, true radius)."""
    out = []
    rest = members
    while len(rest):
        head = points[rest[:64]]
        dist = np.sqrt(np.maximum(2 * (square - head @ points[rest].T), 0))
        free = np.ones(len(rest), bool)
        for i in range(len(head)):
            if free[i]:
                near = free & (dist[i] <= radius)
                near[i] = True
                own = np.flatnonzero(near)
                own = np.concatenate(([i], own[own != i]))
                out.append((rest[own], float(dist[i, own[1:]].max(initial=0))))
                free &= ~near
        rest = rest[free]
    return out


def cover_tree(v: np.ndarray, leaf: int = LEAF, base: float = BASE) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes) over the rows of ``v``: a node is a run of the order, start and end, whose first row
    is its centre, with its covering radius, its first child and its number of children (0: a leaf)."""
    order = np.arange(len(v))
    square = np.square(v).sum(axis=1)
    top = float(square.max(initial=0))
    if not math.isfinite(top) or len(v) <= leaf:  # no distances, or no need of them
        return order, np.array([[0, len(v), np.inf, 0, 0]], float)
    points = np.column_stack((v, np.sqrt(np.maximum(top - square, 0))))
    first = float(np.sqrt(np.maximum(2 * (top - points @ points[0]), 0)).max())
    nodes = [[0, len(v), first, 0, 0]]
    at = 0
    while at < len(nodes):
        start, end, radius = nodes[at][:3]
        if end - start > leaf and radius > 0:
            level = first
            while level >= radius:
                level /= base
            parts = _cover(points, top, order[start:end].copy(), level)
            nodes[at][3:] = len(nodes), len(parts)
            for members, its_radius in parts:
                order[start:start + len(members)] = members
                nodes.append([start, start + len(members), its_radius, 0, 0])
                start += len(members)
        at += 1
    return order, np.array(nodes, float)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of the runs [start, start + size), one after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Tile:
    """A tile's vectors in the order of its tree, ready to be searched."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, nodes: np.ndarray):
        self.ids, self.labels, self.v = ids, labels, v
        self.start, self.end, self.child, self.children = nodes[:, [0, 1, 3, 4]].astype(np.int64).T
        self.radius = nodes[:, 2]
        self.centres = v[self.start]
        self.top = float(np.square(v).sum(axis=1).max(initial=0))

    def scores(self, rows, q: np.ndarray) -> np.ndarray:
        """Exact inner products of some rows."""
        if self.exact(q):
            return (self.v[rows] @ q).astype(np.int64)
        mine = [int(c) for c in q]
        sums = [sum(a * int(b) for a, b in zip(mine, row, strict=True)) for row in self.v[rows]]
        return np.array([max(-_LIMIT, min(_LIMIT, s)) for s in sums], np.int64)

    def exact(self, q: np.ndarray) -> bool:
        return math.sqrt(self.top) * math.sqrt(float(np.square(q).sum())) < 2.0**52

    def search(self, q: np.ndarray, goal: Goal) -> int:
        """Open the tree best first until no node can improve the goal; returns the rows scored.

        The nodes that wait are opened in batches of the best ones, each larger than the last: the first ones raise
        the goal's bounds, by which most of the others are skipped, and array operations do the rest.
        """
        far = self.top + float(np.square(q).sum())
        if not math.isfinite(far):
            goal.offer(np.arange(len(self.ids)), self.scores(slice(None), q))
            return len(self.ids)
        exact, slack, scored, batch = self.exact(q), 1 + 1e-6 * far, 0, FIRST_BATCH
        waiting, low_w, high = np.zeros(1, np.int64), np.array([-np.inf]), np.array([np.inf])
        while len(waiting):
            if len(waiting) > batch:
                best = np.argpartition(-high, batch)
                now, rest = best[:batch], best[batch:]
            else:
                now, rest = np.arange(len(waiting)), np.empty(0, np.int64)
            batch *= 2
            opened = waiting[now]
            leaf = self.children[opened] == 0
            if leaf.any():
                rows = _runs(self.start[opened[leaf]], self.end[opened[leaf]] - self.start[opened[leaf]])
                goal.offer(rows, self.scores(rows, q))
                scored += len(rows)
            inner = opened[~leaf]
            nodes = _runs(self.child[inner], self.children[inner])
            dots = self.centres[nodes] @ q
            dist, r = np.sqrt(np.maximum(far - 2 * dots, 0)), self.radius[nodes]
            low, up = (far - np.square(dist + r)) / 2 - slack, (far - np.square(np.maximum(dist - r, 0))) / 2 + slack
            wanted = goal.wants(low, up)
            lone = wanted & (self.end[nodes] - self.start[nodes] == 1)
            if lone.any():  # single vectors are leaves: their score is at hand
                rows = self.start[nodes[lone]]
                goal.offer(rows, dots[lone].astype(np.int64) if exact else self.scores(rows, q))
                scored += len(rows)
                wanted &= ~lone
            low, up = np.concatenate((low_w[rest], low[wanted])), np.concatenate((high[rest], up[wanted]))
            waiting = np.concatenate((waiting[rest], nodes[wanted]))
            on = goal.wants(low, up)
            waiting, low_w, high = waiting[on], low[on], up[on]
        return scored


class Goal:
    """The k best rows of an anchor in each of its windows of scores."""

    def __init__(self, tile: Tile, anchor: int, label: int, same: bool, windows: np.ndarray, k: int):
        self.fits = tile.ids != anchor
        self.fits &= (tile.labels == label) if same else (tile.labels != label)
        self.tile, self.windows, self.k = tile, windows, k
        self.ends = windows.astype(float)  # only to choose nodes, whose bounds have slack
        self.need = self.ends[:, 0].copy()
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]

    def wants(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return ((high[:, None] >= self.need) & (low[:, None] <= self.ends[:, 1])).any(axis=1)

    def offer(self, rows: np.ndarray, scores: np.ndarray) -> None:
        ok = self.fits[rows] & (scores >= self.need.min()) & (scores <= self.ends[:, 1].max())
        if not ok.any():
            return
        ids, scores = self.tile.ids[rows[ok]], scores[ok]
        for j, (low, high) in enumerate(self.windows):
            held_ids, held = self.best[j]
            least = held[-1] if len(held) == self.k else low
            inside = (scores >= max(low, least)) & (scores <= high)
            if not inside.any():
                continue
            held_ids, held = np.concatenate((held_ids, ids[inside])), np.concatenate((held, scores[inside]))
            first = np.lexsort((held_ids, -held))[:self.k]
            self.best[j] = held_ids[first], held[first]
            if len(first) == self.k:
                self.need[j] = max(self.need[j], float(held[first[-1]]))


_TREE = "dim int, ids binary, labels binary, vectors binary, nodes binary"


def _plant(scale: int, tile_rows: int | None):
    def built(parts: list[tuple]) -> pa.RecordBatch:
        ids, labels, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        order, nodes = cover_tree(v)
        return pa.RecordBatch.from_arrays([
            pa.array([v.shape[1]], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in (ids[order], labels[order], v[order], nodes)]],
            names=["dim", "ids", "labels", "vectors", "nodes"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        count: dict[int, int] = {}
        for batch in batches:
            lengths = pc.list_value_length(batch.column("x")).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths).tolist():
                own = batch.filter(pa.array(lengths == dim))
                v = np.floor(scale * own.column("x").flatten().to_numpy().reshape(own.num_rows, dim))
                v = np.nan_to_num(v)  # a product beyond the doubles is the largest of them
                ids, labels = own.column("vec_id").to_numpy(), own.column("label").to_numpy()
                tile = tile_rows or max(1, TILE_BYTES // (8 * max(1, dim)))
                a = 0
                while a < len(ids):
                    b = min(len(ids), a + tile - count.get(dim, 0))
                    held.setdefault(dim, []).append((ids[a:b], labels[a:b], v[a:b]))
                    count[dim] = count.get(dim, 0) + b - a
                    if count[dim] == tile:
                        yield built(held.pop(dim))
                        del count[dim]
                    a = b
            if sum(c * max(1, d) for d, c in count.items()) * 8 > 4 * TILE_BYTES:  # vectors of many lengths
                yield from (built(held.pop(d)) for d in list(held))
                count.clear()
        yield from (built(p) for p in held.values())
        release()
    return run


def plant(vectors: DataFrame, scale: int = SCALE, tile_rows: int | None = None) -> DataFrame:
    """The cover trees of all tiles of ``usable`` vectors, one row each, kept in the shared folder.

    The vectors are dealt evenly, so that the tiles are full however small the files are: a tile for each
    task, or for more than the shuffle's tasks about eight.
    """
    size = (vectors.agg(F.sum(F.size("x"))).first()[0] or 0) * 8
    tiles, tasks = -(-size // TILE_BYTES), int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, tiles if tiles <= tasks else max(tasks, -(-tiles // 8)))
    return keep(vectors.repartition(parts).mapInArrow(_plant(scale, tile_rows), _TREE), "negatives-trees")


def _pack(scale: int, per_window: tuple[int, int] | None):
    """One row for a block of anchors; ``per_window`` is (low, high) in per cent of the positives' scores."""
    def run(block: pa.Table) -> pa.Table:
        dim = block.column("dim")[0].as_py()
        v = np.nan_to_num(np.floor(scale * block.column("x").combine_chunks().flatten().to_numpy().reshape(block.num_rows, dim)))
        ids, labels = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
        found = block.column("positives").to_pylist()
        width = max(map(len, found), default=0)
        goals = np.zeros((len(ids), max(1, width), 4), np.int64)  # least and largest score, positive's id and score
        goals[:, :, 0], goals[:, :, 1] = (-_LIMIT, _LIMIT) if per_window is None else (_LIMIT, -_LIMIT)
        for i, own in enumerate(found):
            for j, p in enumerate(own):
                low, high = -(-per_window[0] * p["score"] // 100), per_window[1] * p["score"] // 100
                goals[i, j] = [max(-_LIMIT, min(_LIMIT, x)) for x in (low, high, p["vec_id"], p["score"])]
        return pa.table({"dim": pa.array([dim], pa.int32()), "asked": pa.array([ids.tobytes()], pa.binary()),
                         "asked_labels": pa.array([labels.tobytes()], pa.binary()), "q": pa.array([v.tobytes()], pa.binary()),
                         "goals": pa.array([goals.tobytes()], pa.binary())})
    return run


_BLOCK = "dim int, asked binary, asked_labels binary, q binary, goals binary"
_FOUND = "anchor_id long, place int, positive_id long, positive_score long, vec_id long, score long"


def _search(same: bool, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                def read(name, kind=np.int64, row=row, batch=batch):
                    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)

                dim, ids, asked = batch.column("dim")[row].as_py(), read("ids"), read("asked")
                tile = Tile(ids, read("labels"), read("vectors", float).reshape(len(ids), dim), read("nodes", float).reshape(-1, 5))
                q, goals = read("q", float).reshape(len(asked), dim), read("goals").reshape(len(asked), -1, 4)
                out = []
                for i, (anchor, label) in enumerate(zip(asked.tolist(), read("asked_labels").tolist(), strict=True)):
                    goal = Goal(tile, anchor, label, same, goals[i, :, :2], k)
                    tile.search(q[i], goal)
                    for j, (got, scores) in enumerate(goal.best):
                        if len(got):
                            fixed = np.array([anchor, j, goals[i, j, 2], goals[i, j, 3]])
                            out.append(np.column_stack((np.broadcast_to(fixed, (len(got), 4)), got, scores)))
                if out:
                    x = np.concatenate(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[:, j], pa.int32() if j == 1 else pa.int64()) for j in range(6)],
                        names=["anchor_id", "place", "positive_id", "positive_score", "vec_id", "score"])
        release()
    return run


def _best(trees: DataFrame, slots: int, anchors: DataFrame, n_blocks: int, same: bool, k: int, scale: int,
          per_window: tuple[int, int] | None) -> DataFrame:
    """The k best rows for each window of each anchor: _FOUND and rank."""
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
    blocks = anchors.withColumn("block", block).groupBy("dim", "block").applyInArrow(_pack(scale, per_window), _BLOCK)
    dealt = blocks.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    planted = trees.withColumn("slot", F.pmod(F.xxhash64("ids", "labels", "vectors"), F.lit(slots).cast("long")))
    met = dealt.join(planted, ["dim", "slot"]).mapInArrow(_search(same, k), _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
                   high: int = HIGH, scale: int = SCALE, tile_rows: int | None = None, block: int = BLOCK) -> DataFrame:
    """For each anchor and each of its best vectors of the same label: the best vectors of other labels whose
    score lies between ``low`` and ``high`` per cent of that vector's.

    ``vectors`` has vec_id, label and embedding; ``is_anchor`` is a condition on them. Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.
    """
    spark = configure(vectors.sparkSession)
    trees = plant(usable(vectors), scale, tile_rows)
    asked = usable(vectors.where(is_anchor)).groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("row"))
    asked = keep(asked.select("vec_id", "row.*", F.size("row.x").alias("dim")), "negatives-anchors")
    slots, n = trees.count(), asked.count()
    if not slots or not n:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    n_blocks = -(-n // block)
    nothing = F.array().cast("array<struct<score: long, vec_id: long>>")
    near = _best(trees, slots, asked.withColumn("positives", nothing), n_blocks, True, positives, scale, None)
    near = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "score", F.col("vec_id").alias("id")))),
                    lambda p: F.struct(p.score.alias("score"), p.id.alias("vec_id"))).alias("positives"))
    anchors = keep(asked.join(near, "vec_id"), "negatives-positives")
    far = _best(trees, slots, anchors, n_blocks, False, negatives, scale, (low, high))
    return far.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: all embeddings, with the labels of every seventh vector moved on."""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    label = F.col("label").cast("long")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives(moved, F.col("vec_id") % EVERY == 0)


ORACLE = f"""
WITH ok AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS line,
           list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS (
    SELECT vec_id, label, line, len(v) AS d, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM ok
), scores AS (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.line, c.vec_id, CAST(sum(a.x * c.x) AS BIGINT) AS score
    FROM cells a JOIN cells c ON a.i = c.i AND a.d = c.d AND a.vec_id <> c.vec_id
    WHERE a.vec_id % {EVERY} = 0 GROUP BY ALL
), near AS (
    SELECT anchor_id, vec_id AS positive_id, line AS its_line, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, its_line ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM near JOIN scores USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
