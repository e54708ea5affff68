"""Metric time-series operators (Q01-Q11): dashboard queries as DataFrame plans over long samples
``(ts, metric, labels MAP<STRING,STRING>, value)``.

Series are identified by a canonical text of their sorted labels (maps cannot be grouped).
Per-series scans (lag, running sums) use the segmented scans of ``operators.windows``, so a
series that carries most of the samples is still split by day across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import LATENCY_BUCKETS, prom_match, seconds_between
from tillbook.operators.windows import running_sum, segment_bucket, sequence_scan


def series_key(labels: str = "labels") -> Column:
    """Canonical ``k=v,k=v`` text of a label map (sorted by key)."""
    entries = F.array_sort(F.map_entries(F.col(labels)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def time_bucket(ts: str, seconds: int) -> Column:
    """Start of the tumbling window of ``seconds`` that holds ``ts`` (zone-less)."""
    secs = F.unix_seconds(F.col(ts).cast("timestamp"))
    return F.timestamp_seconds(secs - F.pmod(secs, F.lit(seconds))).cast("timestamp_ntz")


def counter_samples(events: DataFrame, metric: str, label_cols: Sequence[str], ts: str = "ts", tie: str = "event_id",
                    reset_every: str | None = "day") -> DataFrame:
    """A counter series per label combination: the running count of events (restarting every
    ``reset_every`` to exercise reset handling), one sample per event."""
    keys = list(label_cols)
    part = keys + (["_epoch"] if reset_every else [])
    d = events.select(*keys, ts, tie, F.lit(1).alias("_one"))
    if reset_every:
        d = d.withColumn("_epoch", F.date_trunc(reset_every, F.col(ts)).cast("timestamp_ntz"))
    run = running_sum(d, part, [ts, tie], "_one", "value", segment_bucket(ts))
    labels = F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k).cast("string"))])
    return run.select(F.col(ts).alias("ts"), F.col(tie).alias("sample_id"), F.lit(metric).alias("metric"),
                      labels.alias("labels"), F.col("value").cast("double").alias("value"))


def match(samples: DataFrame, matchers: dict[str, tuple[str, str]]) -> DataFrame:
    """Q03: PromQL label matchers, e.g. ``{"result": ("!~", "ok|out_of_stock")}``."""
    cond = F.lit(True)
    for label, (op, pattern) in matchers.items():
        cond = cond & prom_match(F.coalesce(F.col("labels")[label], F.lit("")), op, pattern)
    return samples.filter(cond)


def counter_deltas(samples: DataFrame) -> DataFrame:
    """Per-sample increase of a counter with reset handling: ``v < prev`` means a restart, so the
    increase is ``v``; the first sample of a series counts from 0."""
    s = samples.withColumn("_series", series_key())
    lagged = sequence_scan(s, ["_series"], ["ts", "sample_id"], segment_bucket("ts"), lag_cols=["value"])
    prev = F.col("prev_value")
    delta = F.when(prev.isNull(), F.col("value")).when(F.col("value") < prev, F.col("value")) \
        .otherwise(F.col("value") - prev)
    return lagged.withColumn("delta", delta).drop("prev_value")


def increase(samples: DataFrame, window_seconds: int, by: Sequence[str]) -> DataFrame:
    """Q02: increase per tumbling window, summed by labels.

    Deviation from PromQL: no extrapolation to the window edges; each increase is attributed
    to the window of the later sample, so the windows add up to the exact total.
    """
    d = counter_deltas(samples)
    return (d.groupBy(time_bucket("ts", window_seconds).alias("window"), *[F.col("labels")[b].alias(b) for b in by])
            .agg(F.sum("delta").alias("increase")))


def rate(samples: DataFrame, window_seconds: int, by: Sequence[str]) -> DataFrame:
    """Q01: ``sum by (by) (rate(counter[w]))`` over tumbling windows (see ``increase``)."""
    inc = increase(samples, window_seconds, by)
    return inc.select("window", *by, F.round(F.col("increase") / F.lit(float(window_seconds)), 6).alias("rate"))


def _le_label(b: float) -> str:
    return repr(float(b))


def histogram(df: DataFrame, value: Column, by: Sequence[str], bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Q04: cumulative histogram (``le`` buckets plus ``+Inf``) of raw observations, one pass.

    One ``count_if`` per bound, then an ``inline`` unpivot: no join, no explode of the data.
    """
    aggs = [F.count_if(value <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    aggs.append(F.count(F.lit(1)).alias(f"_b{len(bounds)}"))
    labels = [_le_label(b) for b in bounds] + ["+Inf"]
    les = [float(b) for b in bounds] + [None]
    arr = F.array(*[F.struct(F.lit(i).alias("bucket"), F.lit(lab).alias("le"),
                             F.lit(le).cast("double").alias("upper"), F.col(f"_b{i}").alias("cumulative"))
                    for i, (lab, le) in enumerate(zip(labels, les))])
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(arr))


def histogram_quantile(buckets: DataFrame, q: float, by: Sequence[str]) -> DataFrame:
    """Q05: PromQL ``histogram_quantile`` on cumulative buckets (bucket, upper, cumulative).

    rank = q x total; the first bucket whose cumulative count reaches the rank is interpolated
    linearly between its lower and upper bound (lower = 0 for the first bucket). A rank in the
    ``+Inf`` bucket returns the last finite bound; an empty histogram gives null.
    The window runs per group over the fixed, small set of buckets.
    """
    w = Window.partitionBy(*by).orderBy("bucket")
    b = (buckets.withColumn("_prev_cum", F.coalesce(F.lag("cumulative").over(w), F.lit(0)))
         .withColumn("_lower", F.coalesce(F.lag("upper").over(w), F.lit(0.0)))
         .withColumn("_total", F.max("cumulative").over(Window.partitionBy(*by)))
         .withColumn("_rank", F.lit(q) * F.col("_total")))
    hit = b.filter((F.col("_total") > 0) & (F.col("cumulative") >= F.col("_rank")))
    first = hit.groupBy(*by).agg(F.min_by(F.struct("upper", "_lower", "_prev_cum", "cumulative", "_rank"),
                                          F.col("bucket")).alias("h"))
    h = F.col("h")
    interp = h["_lower"] + (h["upper"] - h["_lower"]) * (h["_rank"] - h["_prev_cum"]) / (h["cumulative"] - h["_prev_cum"])
    val = F.when(h["upper"].isNull(), h["_lower"]).otherwise(interp)
    groups = buckets.select(*by).distinct()
    return groups.join(first.select(*by, F.round(val, 6).alias("quantile")), list(by), "left") \
        .withColumn("q", F.lit(q))


def latest(samples: DataFrame, at: Column | None = None) -> DataFrame:
    """Q06 helper: the latest sample of every series (at or before ``at``), as an aggregate."""
    s = samples if at is None else samples.filter(F.col("ts") <= at)
    return (s.withColumn("_series", series_key())
            .groupBy("_series").agg(F.max_by(F.struct("ts", "metric", "labels", "value"), F.struct("ts", "sample_id"))
                                     .alias("s"))
            .select("s.*"))


def agg_by(samples: DataFrame, fn: str, by: Sequence[str], default: float | None = 0.0) -> DataFrame:
    """Q06: ``fn by (by) (latest samples)``; ``or vector(default)`` when no series matches."""
    f = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}[fn]
    g = samples.groupBy(*[F.col("labels")[b].alias(b) for b in by]).agg(f("value").cast("double").alias("value"))
    if default is None or by:
        return g
    return g.select(F.coalesce(F.col("value"), F.lit(default)).alias("value"))


def sort_desc(groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Q06: ``sort_desc``: groups with their place by falling value (one row a group; ties by the labels)."""
    return groups.withColumn("place", F.row_number().over(Window.orderBy(F.col("value").desc(), *by)).cast("bigint"))


def outages(checks: DataFrame, target: str = "target", ts: str = "ts", tie: str = "event_id", ok: str = "ok",
            error: str = "error") -> DataFrame:
    """Outage intervals from probe checks (islands of consecutive failed checks).

    An outage runs from the first failed check to the next successful one (X17); ``last_ok`` is
    the successful check before it; an outage without a later success is open (end null).
    One segmented scan over the checks gives each check the previous check (status, time) and
    the running count of successful checks. The failed checks of one outage share that
    count, the outage ends at the successful check that follows a failure, and the check
    before the outage's first failure is its ``last_ok``. Outages are then numbered by a
    second scan over the outages only. No target is ever processed by a single task.
    """
    d = checks.select(F.col(target).alias("target"), F.col(ts).alias("ts"), F.col(tie).alias("tie"),
                      F.col(ok).alias("ok"), F.col(error).alias("error"), F.col(ok).cast("int").alias("_okc"))
    d = sequence_scan(d, ["target"], ["ts", "tie"], segment_bucket("ts"), lag_cols=["ok", "ts"], sum_cols=["_okc"])
    failed = (d.filter(~F.col("ok")).groupBy("target", F.col("run__okc").alias("_grp"))
              .agg(F.min("ts").alias("start"), F.count(F.lit(1)).alias("failed_checks"),
                   F.min_by("error", F.struct("ts", "tie")).alias("error"),
                   F.min_by("prev_ts", F.struct("ts", "tie")).alias("last_ok")))
    ends = (d.filter(F.col("ok") & (F.col("prev_ok") == F.lit(False)))
            .select("target", (F.col("run__okc") - 1).alias("_grp"), F.col("ts").alias("end")))
    out = failed.join(ends, ["target", "_grp"], "left").withColumn("_one", F.lit(1))
    out = running_sum(out, ["target"], ["start", "_grp"], "_one", "outage", segment_bucket("start"))
    return out.select("target", F.col("outage").cast("bigint").alias("outage"), "start", "end",
                      F.round(seconds_between("start", "end"), 3).alias("duration_s"), "last_ok",
                      F.col("failed_checks").cast("bigint").alias("failed_checks"), "error",
                      F.col("end").isNull().alias("open"))


def availability(checks: DataFrame, outage_df: DataFrame, start: Column, end: Column, as_of: Column) -> DataFrame:
    """Q08: per target: up now, ongoing outage seconds, downtime and outages overlapping [start, end)."""
    now = latest(checks.select("ts", F.col("event_id").alias("sample_id"), F.lit("up").alias("metric"),
                               F.create_map(F.lit("target"), F.col("target")).alias("labels"),
                               F.col("ok").cast("double").alias("value")), as_of)
    up = now.select(F.col("labels")["target"].alias("target"), F.col("value").cast("int").alias("up"))
    o = outage_df.withColumn("_end", F.coalesce(F.col("end"), as_of))
    clipped = seconds_between(F.greatest(F.col("start"), start), F.least(F.col("_end"), end))
    overl = (F.col("start") < end) & (F.col("_end") > start)
    per = o.groupBy("target").agg(
        F.round(F.sum(F.when(overl, clipped).otherwise(0.0)), 3).alias("downtime_s"),
        F.count_if(overl).alias("outages"),
        F.round(F.max(F.when(F.col("end").isNull(), seconds_between(F.col("start"), as_of))), 3).alias("ongoing_s"))
    return (up.join(per, "target", "left")
            .select("target", "up", F.coalesce("ongoing_s", F.lit(0.0)).alias("current_outage_s"),
                    F.coalesce("downtime_s", F.lit(0.0)).alias("downtime_s"),
                    F.coalesce("outages", F.lit(0)).cast("bigint").alias("outages")))


def state_timeline(df: DataFrame, key: str, ts: str, tie: str, value: Column, mapping: dict) -> DataFrame:
    """Q10: value changes -> intervals (start, end = next change) with a value mapping."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    d = df.select(F.col(key).alias("key"), F.col(ts).alias("ts"), F.col(tie).alias("tie"), value.alias("v"))
    ch = sequence_scan(d, ["key"], ["ts", "tie"], segment_bucket("ts"), lag_cols=["v"])
    ch = ch.filter(~F.col("prev_v").eqNullSafe(F.col("v"))).drop("prev_v")
    nxt = sequence_scan(ch, ["key"], ["ts", "tie"], segment_bucket("ts"), lag_cols=["ts"], prefix_lag="next_",
                        descending=True)
    return nxt.select(F.col("key").alias(key), F.col("ts").alias("start"), F.col("next_ts").alias("end"),
                      F.col("v").alias("value"), F.element_at(m, F.col("v")).alias("state"))


def job_stats(runs: DataFrame) -> DataFrame:
    """Q11: per job: runs by result, duration of the latest run, and overlapping runs (a run that
    starts before the previous run of the same job finished)."""
    lagged = sequence_scan(runs, ["job_name"], ["started_at", "run_id"], segment_bucket("started_at"),
                           lag_cols=["finished_at"])
    overlap = F.col("prev_finished_at").isNotNull() & (F.col("started_at") < F.col("prev_finished_at"))
    return lagged.groupBy("job_name").agg(
        F.count_if(F.col("result") == "ok").alias("ok_runs"),
        F.count_if(F.col("result") != "ok").alias("other_runs"),
        F.round(F.max_by(seconds_between("started_at", "finished_at"), F.struct("started_at", "run_id")), 3)
        .alias("last_duration_s"),
        F.count_if(overlap).alias("overlaps"))


def over_time(df: DataFrame, value: str, by: Sequence[str], fn: str = "sum", resolution: float = 5.0) -> DataFrame:
    """Q09: ``sum_over_time`` / ``max_over_time`` of a gauge x the sample interval (e.g. blocked session-seconds)."""
    f = {"sum": F.sum, "max": F.max}[fn]
    return df.groupBy(*by).agg((f(value) * F.lit(resolution)).alias(f"{fn}_over_time"))
