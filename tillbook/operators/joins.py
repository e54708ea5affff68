"""Join operators the reference needs beyond a plain equi join.

No operator here broadcasts a side whose size grows with the data; AQE decides from
measured shuffle sizes. Hot keys are split by time segments (as-of join) or left to AQE's
skew-join handling (equi joins with a range condition).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillbook.operators.windows import segment_bucket
from tillbook.session import scratch_path

_UNB = Window.unboundedPreceding


def _key_match(keys: Sequence[str], left: str = "l", right: str = "r") -> Column:
    cond = None
    for k in keys:
        c = F.col(f"{left}.{k}") == F.col(f"{right}.{k}")
        cond = c if cond is None else cond & c
    return cond


def anti_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b`` (NOT EXISTS semantics)."""
    return a.join(b.select(*keys).distinct(), list(keys), "left_anti")


def semi_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is in ``b`` (IN / EXISTS)."""
    return a.join(b.select(*keys), list(keys), "left_semi")


def not_in(a: DataFrame, col: str, b: DataFrame, bcol: str) -> DataFrame:
    """SQL ``x NOT IN (SELECT y FROM b)`` with its null rules, without a nested-loop join.

    A hash anti join on the value, then two scalar subqueries over ``b`` (row count, any
    null) decide the null cases: a null in ``b`` empties the result; a null ``x`` survives
    only when ``b`` is empty. Each is one value, computed once.
    """
    n = b.agg(F.count(F.lit(1))).scalar()
    has_null = b.agg(F.max(F.col(bcol).isNull().cast("int"))).scalar()
    kept = a.join(b.select(F.col(bcol).alias("_v")).distinct(), F.col(col) == F.col("_v"), "left_anti")
    ok = (n == 0) | (F.col(col).isNotNull() & (F.coalesce(has_null, F.lit(0)) == 0))
    return kept.filter(ok)


def first_per_key(child: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The first child row per key (correlated ``ORDER BY .. LIMIT 1``) as a ``min_by`` aggregate."""
    return (child.groupBy(key).agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_first"))
            .select(key, "_first.*"))


def update_from(df: DataFrame, agg: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Rewrite ``cols`` of ``df`` from a grouped child; rows without a match keep their values."""
    renamed = agg.select(*on, *[F.col(c).alias(f"_new_{c}") for c in cols])
    j = df.join(renamed, list(on), "left")
    for c in cols:
        j = j.withColumn(c, F.coalesce(F.col(f"_new_{c}"), F.col(c)))
    return j.drop(*[f"_new_{c}" for c in cols])


def cascade_delete(parent: DataFrame, child: DataFrame, deleted: DataFrame, pkey: str, fkey: str):
    """Delete parents and, by the foreign key, their children. Returns the two new tables."""
    gone = deleted.select(F.col(pkey).alias("_gone")).distinct()
    new_parent = parent.join(gone, F.col(pkey) == F.col("_gone"), "left_anti")
    new_child = child.join(gone, F.col(fkey) == F.col("_gone"), "left_anti")
    return new_parent, new_child


def period_join(lines: DataFrame, periods: DataFrame, key: str, pkey: str, at: str, valid_from: str = "valid_from",
                valid_to: str = "valid_to") -> DataFrame:
    """The period in force at ``at``: equi key plus ``valid_from <= at < valid_to`` (open end = null).

    Planned as a sort-merge (or AQE broadcast) join on the key with the range as a join
    condition; a product that holds a third of all lines is split by AQE's skew join.
    """
    cond = ((F.col(key) == F.col(pkey)) & (F.col(valid_from) <= F.col(at))
            & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to))))
    return lines.join(periods, cond)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
              values: Sequence[str], right_order: Sequence[str] = ()) -> DataFrame:
    """For every left row, the right values in force at ``left_ts`` (latest ``right_ts <= left_ts``).

    Both sides are unioned and scanned per key in time order (a right row at the same instant
    counts as in force). The scan is segmented by time (``windows.segment_bucket``): inside a segment a
    window carries the last right row forward; across segments, one summary row per segment
    carries the last right row of earlier segments. One sort-based pass, no range join and
    no single task per key. Left rows without a match get nulls (left outer semantics).
    """
    keys = list(keys)
    lcols = [c for c in left.columns]
    rord = [F.col(c) for c in right_order]
    r = right.select(*[F.col(k) for k in keys], F.col(right_ts).alias("_t"), F.lit(0).alias("_side"),
                     F.struct(*rord).alias("_ord") if rord else F.struct(F.lit(0).alias("o")).alias("_ord"),
                     F.struct(*values).alias("_v"), F.lit(None).alias("_l"))
    lft = left.select(*[F.col(k) for k in keys], F.col(left_ts).alias("_t"), F.lit(1).alias("_side"),
                      F.lit(None).cast(r.schema["_ord"].dataType).alias("_ord"),
                      F.lit(None).cast(r.schema["_v"].dataType).alias("_v"),
                      F.struct(*[F.col(c) for c in lcols]).alias("_l"))
    r = r.withColumn("_l", F.lit(None).cast(lft.schema["_l"].dataType))
    u = r.unionByName(lft).withColumn("_seg", segment_bucket("_t"))
    seg = keys + ["_seg"]
    w_in = Window.partitionBy(*seg).orderBy("_t", "_side", "_ord").rowsBetween(_UNB, Window.currentRow)
    u = u.withColumn("_in", F.last("_v", ignorenulls=True).over(w_in))
    is_r = F.col("_side") == 0
    segs = u.groupBy(*seg).agg(
        F.max_by(F.when(is_r, F.col("_v")), F.when(is_r, F.struct("_t", "_ord"))).alias("_seg_last"))
    w_seg = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(_UNB, -1)
    segs = segs.select(*seg, F.last("_seg_last", ignorenulls=True).over(w_seg).alias("_carry"))
    out = u.filter(F.col("_side") == 1).join(segs, seg)
    v = F.coalesce(F.col("_in"), F.col("_carry"))
    return out.select("_l.*", *[v.getField(c).alias(c) for c in values])


def transitive_closure(edges: DataFrame, part: Sequence[str], src: str, dst: str) -> DataFrame:
    """Root -> waiter pairs of a waits-for graph, per partition ``part`` (e.g. per sample).

    ``edges`` has one row per (waiter ``src``, blocker ``dst``). Roots are blockers that wait
    for nothing. The chain is found by *pointer doubling*: round k holds the jumps of exactly 2^k
    edges and the pairs (waiter, root) within 2^k edges, and one join of the jumps with both gives
    those of the next round. So a queue of n sessions takes log2(n) rounds, not n.

    It ends when no jump is left, or when a round finds no new pair. That is exact also
    with cycles (X14): were a root further than 2^(k+1) edges away from some waiter, a session on the
    shortest way to it would be at a distance between 2^k and 2^(k+1), and its pair would be new.
    Sessions of a cycle that leads to no root are in no pair.

    Each round is one job that writes its table, hash-partitioned by the last distinct, to the shared
    checkpoint folder: lineage stays one round long, and a lost executor costs tasks of one round.
    Both sides of the join are plain exchanges of that table, so AQE can split a hot blocker.
    """
    part = list(part)
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, int, int]:
        """The table, its pairs and its jumps, counted by an observed metric of the writing job."""
        seen, path = Observation(), scratch_path(spark, "closure")
        df.observe(seen, F.count_if("root").alias("pairs"), F.count_if(~F.col("root")).alias("jumps")).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), seen.get["pairs"], seen.get["jumps"]

    e = edges.select(*part, F.col(src).alias("_w"), F.col(dst).alias("_to")).distinct()
    waiting = e.select(*part, F.col("_w").alias("_to"), F.lit(True).alias("_waits")).distinct()
    now, pairs, jumps = written(e.join(waiting, part + ["_to"], "left")
                                .select(*part, "_w", "_to", F.col("_waits").isNull().alias("root")))
    while jumps:
        onward = now.select(*part, F.col("_w").alias("_via"), F.col("_to").alias("_end"), F.col("root").alias("_root"))
        further = (now.filter(~F.col("root")).withColumnRenamed("_to", "_via").join(onward, part + ["_via"])
                   .select(*part, "_w", F.col("_end").alias("_to"), F.col("_root").alias("root")))
        before = pairs
        now, pairs, jumps = written(now.filter("root").unionByName(further).distinct())
        if pairs == before:
            break
    return now.filter("root").select(*part, F.col("_to").alias("root_pid"), F.col("_w").alias("waiting_pid"))
