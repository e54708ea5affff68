"""Window operators (W03-W09) that stay distributed when one key holds a large share of rows.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. The sequence
operators here split each key into *segments* (``key`` x a bucket that is monotone in the
order, e.g. the day) and scan in two passes:

1. inside each segment: a window partitioned by ``(key, bucket)``;
2. across segments: one summary row per segment (an aggregation with map-side combine),
   a window over those few rows per key gives each segment its carry-in (offsets for
   running sums, the last row of the previous segment for ``lag``), joined back on the
   segment key (the join reuses the segment partitioning of pass 1).

A hot key therefore costs one task per *segment*, never one task for the whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_UNB = Window.unboundedPreceding


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def last_n(df: DataFrame, keys: Sequence[str], order: Sequence, n: int, rn: str = "rn") -> DataFrame:
    """The first ``n`` rows per key in ``order`` (ties broken by the caller's order).

    ``row_number() <= n`` is planned with a partial WindowGroupLimit *before* the shuffle, so
    each map task ships at most ``n`` rows per key however hot the key is.
    """
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str] | None = None,
                   first: bool = False) -> DataFrame:
    """The latest (or first) row per key as an aggregation (``max_by``/``min_by`` on a struct).

    An aggregate combines map-side, so a hot key is reduced before the shuffle.
    """
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in keys]
    pick = F.min_by if first else F.max_by
    agg = pick(F.struct(*cols), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(agg).select(*keys, "_row.*")


def sequence_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                  lag_cols: Sequence[str] = (), sum_cols: Sequence[str] = (), prefix_lag: str = "prev_",
                  prefix_sum: str = "run_", descending: bool = False) -> DataFrame:
    """Per key in ``order``: ``lag(1)`` of ``lag_cols`` and inclusive running sums of ``sum_cols``.

    ``bucket`` must be non-decreasing in ``order`` within a key (e.g. ``date_trunc('day', ts)``)
    and ``order`` must be unique within a key. Exact for any data; the bucket only decides
    how a key is split across tasks. ``descending`` scans the order backwards (``lead``).
    """
    keys, order = list(keys), list(order)
    seg = keys + ["_seg"]
    d = df.withColumn("_seg", -bucket if descending else bucket)
    sort = [F.col(c).desc() for c in order] if descending else [F.col(c) for c in order]
    w_in = Window.partitionBy(*seg).orderBy(*sort)
    for c in lag_cols:
        d = d.withColumn(f"_in_prev_{c}", F.lag(c).over(w_in))
    for c in sum_cols:
        d = d.withColumn(f"_in_run_{c}", F.sum(c).over(w_in.rowsBetween(_UNB, Window.currentRow)))
    d = d.withColumn("_pos", F.row_number().over(w_in))

    aggs = [F.sum(c).alias(f"_tot_{c}") for c in sum_cols]
    if lag_cols:
        pick = F.min_by if descending else F.max_by
        aggs.append(pick(F.struct(*lag_cols), F.struct(*order)).alias("_last"))
    segs = d.groupBy(*seg).agg(*aggs)
    w_seg = Window.partitionBy(*keys).orderBy("_seg")
    carry = [F.coalesce(F.sum(f"_tot_{c}").over(w_seg.rowsBetween(_UNB, -1)), F.lit(0)).alias(f"_off_{c}")
             for c in sum_cols]
    if lag_cols:
        carry.append(F.lag("_last").over(w_seg).alias("_carry_last"))
    segs = segs.select(*seg, *carry)

    out = d.join(segs, seg)
    for c in lag_cols:
        out = out.withColumn(f"{prefix_lag}{c}", F.when(F.col("_pos") == 1, F.col("_carry_last").getField(c))
                             .otherwise(F.col(f"_in_prev_{c}")))
    for c in sum_cols:
        out = out.withColumn(f"{prefix_sum}{c}", F.col(f"_in_run_{c}") + F.col(f"_off_{c}"))
    drop = ["_seg", "_pos"] + [f"_in_prev_{c}" for c in lag_cols] + [f"_in_run_{c}" for c in sum_cols] \
        + [f"_off_{c}" for c in sum_cols] + (["_carry_last"] if lag_cols else [])
    return out.drop(*drop)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
                bucket: Column) -> DataFrame:
    """Running sum of ``value`` per key in ``order`` (segmented, see module doc)."""
    res = sequence_scan(df, keys, order, bucket, sum_cols=[value], prefix_sum="_run_")
    return res.withColumnRenamed(f"_run_{value}", out)


def transitions(df: DataFrame, keys: Sequence[str], order: Sequence[str], status: str, bucket: Column,
                only_changes: bool = True) -> DataFrame:
    """Previous status per row (null on the first); keep rows where it changed."""
    res = sequence_scan(df, keys, order, bucket, lag_cols=[status], prefix_lag="from_")
    if only_changes:
        res = res.filter(~F.col(f"from_{status}").eqNullSafe(F.col(status)))
    return res


def to_periods(df: DataFrame, keys: Sequence[str], start: str, order: Sequence[str], bucket: Column,
               end: str = "valid_to") -> DataFrame:
    """``valid_to`` = the next change's start (``lead``, a backwards segmented scan);
    the last period stays open. ``bucket`` must be numeric and non-decreasing in ``order``."""
    res = sequence_scan(df, keys, order, bucket, lag_cols=[start], prefix_lag="_next_", descending=True)
    return res.withColumnRenamed(f"_next_{start}", end)


# Width of the time segments of the segmented scans. A day by default; on a cluster where one
# key holds a large share of the rows, set it narrower so that one key's segment is a
# task-sized slice (results never depend on it, only the task sizes do).
SEGMENT_CONF = "spark.tillbook.segmentSeconds"


def segment_seconds() -> int:
    spark = SparkSession.getActiveSession()
    value = spark.conf.get(SEGMENT_CONF, None) if spark is not None else None
    return int(value) if value else 86_400


def segment_bucket(ts: str) -> Column:
    """Segment id for the segmented scans: epoch time // segment width (``segment_seconds``)."""
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(segment_seconds() * 1_000_000)).cast("long")


def rolling_sum_segmented(df: DataFrame, keys: Sequence[str], ts: str, value: str, seconds: int,
                          out: str) -> DataFrame:
    """``sum(value)`` over ``[t - seconds, t]`` per key (a RANGE frame, peers included),
    without putting a whole key in one ordered partition.

    Time is cut into buckets as wide as the window. A row's window then lies inside its own
    bucket and the previous one. So every row is also copied once into the next bucket as
    context, and a RANGE frame runs per (key, bucket). This is one shuffle and exact, it
    doubles the rows at most, and a hot key is split into one task per bucket.
    """
    keys = list(keys)
    span = seconds * 1_000_000
    d = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    d = d.withColumn("_b", F.floor(F.col("_t") / F.lit(span)).cast("long")).withColumn("_probe", F.lit(True))
    ctx = d.select(*keys, "_t", (F.col("_b") + 1).alias("_b"), value, F.lit(False).alias("_probe"))
    w = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(-span, 0)
    return (d.unionByName(ctx, allowMissingColumns=True).withColumn(out, F.sum(value).over(w))
            .filter(F.col("_probe")).drop("_t", "_b", "_probe"))
