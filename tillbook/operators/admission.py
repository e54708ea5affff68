"""Set-based sequential admission (M03, M12, M14): decide requests against finite capacities
exactly as if they were applied one by one in request order, without a per-row loop.

A request consumes ``amount`` on each of its keys (e.g. every (warehouse, product) of an
order, or a player's day); it is accepted only if *all* its keys still have room, and a
refused request consumes nothing.

Before the rounds, keys whose whole demand fits their capacity are set aside: they can refuse nobody.
Requests on such keys only are accepted at once (round 0), and only the lines of contested keys go on.
Each round then computes, per key and in request order:

* ``hi`` - consumption of earlier requests that are accepted *or undecided*,
* ``lo`` - consumption of earlier requests that are accepted.

An undecided request with ``hi + own <= cap`` on every key is accepted whatever the
undecided ones do; one with ``lo + own > cap`` on some key is refused. The earliest
undecided request has ``lo == hi``, so every round decides at least one request and the
loop ends; in practice a handful of rounds decide everything.

What is decided leaves the state by *capacity folding*: refused lines go, keys without undecided requests go,
and the accepted lines before a key's first undecided request are subtracted from its capacity. Only accepted
lines behind an undecided one stay. While every key has few lines, the folding and the running sums of a round
are windows over one exchange by key; with a hot key the sums use the segmented scan, which splits
it by request-number buckets. A round is one job that writes the lines with their verdicts to the shared
folder: lineage stays one round long, and a lost executor costs tasks of one round.

The lines are written once and counted by that job, as every step reads them; many lines are dealt into more
partitions than the session's (``spread``), so that a task's share does not grow with the input. The verdicts of all
rounds are written once too: over the union itself, whose rounds are dealt alike, Spark drops the exchange that a
later ``spread`` asks for, and the union it runs after re-planning may have other partitions ("Can't zip RDDs").
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillbook.operators.windows import sequence_scan
from tillbook.session import scratch_path


KEY_LINES = 200_000  # a key of more lines counts as hot
TASK_ROWS = 1_000_000  # the rows that a task is given, on average, at most


def stored(df: DataFrame) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read back, and its number of rows."""
    spark, seen, path = df.sparkSession, Observation(), scratch_path(df.sparkSession, "stored")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["rows"]


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in partitions of about ``TASK_ROWS``, if ``rows`` (of it, or of what it is joined with) are
    too many for the session's number of partitions."""
    parts = -(-rows // TASK_ROWS)
    return df.repartition(parts, *keys) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def _folded(lines: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The live lines of keys with an undecided request, with the accepted ones before it taken off ``cap``."""
    live = lines.filter(F.col("accepted").isNull() | F.col("accepted"))
    first = live.groupBy(*keys).agg(F.min(F.when(F.col("accepted").isNull(), F.col(seq))).alias("_first")).filter("_first IS NOT NULL")
    live = live.join(first, keys)
    settled = F.col("accepted").isNotNull() & (F.col(seq) < F.col("_first"))
    taken = live.groupBy(*keys).agg(F.sum(F.when(settled, F.col("_amt")).otherwise(0)).alias("_taken"))
    return (live.filter(~settled).join(taken, keys)
            .withColumn("cap", (F.col("cap") - F.col("_taken")).cast(dict(lines.dtypes)["cap"])).drop("_first", "_taken"))


def _hot_sums(lines: DataFrame, keys: list[str], seq: str, req: str, bucket_rows: int) -> DataFrame:
    """The folded lines with ``_hi`` and ``_lo``, inclusive running sums, where a key may be too large for one task."""
    cur = (_folded(lines, keys, seq).withColumn("_hi_amt", F.col("_amt"))          # accepted or undecided
           .withColumn("_lo_amt", F.when(F.col("accepted"), F.col("_amt")).otherwise(0)))
    bucket = F.floor(F.col(seq) / F.lit(bucket_rows)).cast("long")
    cur = sequence_scan(cur, keys, [seq, req], bucket, sum_cols=["_hi_amt", "_lo_amt"], prefix_sum="_run")
    return cur.drop("_hi_amt", "_lo_amt").withColumnsRenamed({"_run_hi_amt": "_hi", "_run_lo_amt": "_lo"})


def _sums(lines: DataFrame, keys: list[str], seq: str, req: str) -> DataFrame:
    """The same by windows over the whole key."""
    key = Window.partitionBy(*keys)
    live = lines.filter(F.col("accepted").isNull() | F.col("accepted"))
    live = live.withColumn("_first", F.min(F.when(F.col("accepted").isNull(), F.col(seq))).over(key)).filter("_first IS NOT NULL")
    settled = F.col("accepted").isNotNull() & (F.col(seq) < F.col("_first"))
    live = live.withColumn("_taken", F.sum(F.when(settled, F.col("_amt")).otherwise(0)).over(key)).filter(~settled)
    live = live.withColumn("cap", (F.col("cap") - F.col("_taken")).cast(dict(lines.dtypes)["cap"])).drop("_first", "_taken")
    upto = key.orderBy(seq, req).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return live.withColumn("_hi", F.sum("_amt").over(upto)).withColumn(
        "_lo", F.sum(F.when(F.col("accepted"), F.col("_amt")).otherwise(0)).over(upto))


def admit(lines: DataFrame, capacity: DataFrame, req: str, seq: str, keys: Sequence[str], amount: str,
          bucket_rows: int = 1_000_000, rows: int | None = None) -> DataFrame:
    """Return ``(req, accepted, round)`` for every request.

    ``lines``: one row per (request, key) with its ``seq`` (total order of requests) and
    ``amount``. ``capacity``: one row per key with ``cap``; keys without a row have no room.
    ``rows``: the number of lines, if they are a stored table; else they are written here.
    """
    keys = list(keys)
    spark = lines.sparkSession
    if rows is None:
        lines, rows = stored(lines.select(req, seq, *keys, amount))

    def written(df: DataFrame, **counts) -> tuple[DataFrame, Observation]:
        seen, path = Observation(), scratch_path(spark, "admission")
        df.observe(seen, *[c.alias(n) for n, c in counts.items()]).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), seen

    asked = spread(lines, rows, *keys).groupBy(req, seq, *keys).agg(F.sum(amount).alias("_amt"))
    demand = asked.groupBy(*keys).agg(F.sum("_amt").alias("_demand"), F.count(F.lit(1)).alias("_lines"))
    room = demand.join(spread(capacity.select(*keys, F.col("cap")), rows, *keys), keys, "left").withColumn("cap", F.coalesce(F.col("cap"), F.lit(0)))
    contested = F.col("_demand") > F.col("cap")
    start, seen = written(asked.join(room, keys).withColumn("_contested", contested).drop("_demand"),
                          contested=F.count_if("_contested"), most=F.max(F.when(F.col("_contested"), F.col("_lines"))))
    by_request = spread(start.select(req, "_contested"), rows, req).groupBy(req).agg(F.bool_or("_contested").alias("_waits"))
    decided = [by_request.filter(~F.col("_waits")).select(req, F.lit(True).alias("accepted"), F.lit(0).alias("round"))]
    if seen.get["contested"]:
        state = start.filter("_contested").drop("_contested", "_lines").withColumn("accepted", F.lit(None).cast("boolean"))
        hot = seen.get["most"] > min(KEY_LINES, bucket_rows)
        for rnd in itertools.count(1):
            dealt = spread(state, rows, *keys)
            cur = _hot_sums(dealt, keys, seq, req, bucket_rows) if hot else _sums(dealt, keys, seq, req)
            # the sums are inclusive, so the request's own share is in "hi" and is added to "lo"
            lines_of, open_ = Window.partitionBy(req), F.col("accepted").isNull()
            ok = F.bool_and(F.when(open_, F.col("_hi") <= F.col("cap"))).over(lines_of)
            bad = F.bool_or(F.when(open_, F.col("_lo") + F.col("_amt") > F.col("cap"))).over(lines_of)
            verdict = F.when(F.col(req).isNotNull() & (F.col("_ok") | F.col("_bad")), F.col("_ok"))
            nxt = (spread(cur, rows, req).withColumns({"_ok": ok, "_bad": bad}).withColumn("_verdict", verdict)
                   .withColumn("accepted", F.coalesce("accepted", "_verdict")).withColumn("_new", F.col("_verdict").isNotNull())
                   .drop("_hi", "_lo", "_ok", "_bad", "_verdict"))
            now, seen = written(nxt, left=F.count_if(F.col("accepted").isNull()), new=F.count_if("_new"))
            decided.append(spread(now.filter("_new").select(req, "accepted", F.lit(rnd).alias("round")), rows, req).distinct())
            if not seen.get["left"]:
                break
            if not seen.get["new"]:  # cannot happen (the earliest undecided request is always decided)
                raise RuntimeError("admission made no progress")
            state = now.drop("_new")
    result = decided[0]
    for more in decided[1:]:
        result = result.unionByName(more)
    return stored(result)[0]


def sequential_admit(rows: list[tuple], caps: dict) -> dict:
    """Reference fold for tests: rows = [(req, seq, key, amount)], all-or-nothing per request."""
    by_req: dict = {}
    for r, s, k, a in rows:
        items = by_req.setdefault((s, r), {})
        items[k] = items.get(k, 0) + a
    used: dict = {}
    out = {}
    for (s, r), items in sorted(by_req.items()):
        ok = all(used.get(k, 0) + a <= caps.get(k, 0) for k, a in items.items())
        if ok:
            for k, a in items.items():
                used[k] = used.get(k, 0) + a
        out[r] = ok
    return out
