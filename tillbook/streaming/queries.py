"""Streaming operators (ST01-ST16) and their registered runs.

Each registered query drains a stream over the driver table with ``availableNow`` and
returns the sink as a batch table, so the driver can compare it with the batch oracle
(stream equals batch). Keyed Python state (``applyInPandasWithState``) appears only where
the semantics are a sequential fold: the match state machine (ST02), the outage detector
(ST06), the session expiry (ST07), the status-change capture (ST10) and the running wallet (ST14).
Those folds run on a reorder buffer (``ordered.in_order``) over feeds of several files that arrive
out of order (``feeds``), as do the streams in ``live``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillbook.operators.windows import last_n
from tillbook.plans.registry import register
from tillbook.session import scratch_path
from tillbook.sources.adapters import money_events_v, odds_feed_v, requests_v
from tillbook.functions import LATENCY_BUCKETS
from tillbook.operators.metrics import histogram, histogram_quantile
from tillbook.streaming.feeds import feed
from tillbook.streaming.ordered import Rows, in_order
from tillbook.streaming.runner import (drain_append, drain_batches, drain_upsert, event_time, ntz, stream_table)
from tillbook.sources.adapters import Tables


# ---- ST01 current odds ----------------------------------------------------------------------------

def current_odds(feed: DataFrame) -> DataFrame:
    """The latest odds per selection: ``max_by`` over the moves (update mode, upsert sink)."""
    return feed.groupBy("selection_id").agg(F.max_by(F.struct("odds", "changed_at", "id"),
                                                     F.struct("changed_at", "id")).alias("c")) \
        .select("selection_id", F.col("c.odds").alias("odds"), F.col("c.changed_at").alias("changed_at"),
                F.col("c.id").alias("id"))


@register("stream_current_odds", oracle="""
SELECT user_id AS selection_id,
       first(CAST(1.01 + CAST(event_id % 900 AS DECIMAL(7,3)) / 100 AS DECIMAL(7,3)) ORDER BY ts DESC, event_id DESC) AS odds,
       max(ts) AS changed_at, first(event_id ORDER BY ts DESC, event_id DESC) AS id
FROM events WHERE event_type IN ('view', 'click') GROUP BY 1""")
def q_stream_current_odds(spark, d):
    feed = odds_feed_v(stream_table(spark, d, "events"))
    return drain_upsert(current_odds(feed), "current_odds", ["selection_id"])


def odds_moves(feed_: DataFrame, decided: DataFrame) -> DataFrame:
    """ST01: the moves to be appended to the odds history: those of selections that are not decided. ``decided``
    (selection_id, decided_at) is a table; a move at or after the decision is ignored."""
    d = decided.select(F.col("selection_id").alias("_selection"), "decided_at")
    j = feed_.join(d, F.col("selection_id") == F.col("_selection"), "left")
    return j.filter(F.col("decided_at").isNull() | (F.col("changed_at") < F.col("decided_at"))).drop("_selection", "decided_at")


@register("stream_odds_history", adapters=("odds_feed_v",), oracle="""
SELECT id, changed_at, selection_id, odds FROM odds_feed_v
WHERE selection_id % 4 <> 0 OR changed_at < TIMESTAMP '2024-01-05 00:00:00' + to_days(CAST(selection_id % 20 AS INT))""")
def q_stream_odds_history(spark, d):
    """ST01: the history of a feed of several files, in which a quarter of the selections are decided on some day."""
    t = Tables(spark, d)
    user = F.col("user_id")
    decided = t.events.select(user).distinct().filter(user % 4 == 0).select(
        user.alias("selection_id"), (F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
                                     + F.make_dt_interval(days=(user % 20).cast("int"))).alias("decided_at"))
    moves = odds_moves(feed(t.odds_feed_v, "odds", "changed_at", "id").drop("_et"), decided)
    return drain_append(moves, "odds-history")


# ---- ST03 / ST04 / ST05 request windows ---------------------------------------------------------------

def request_counts(requests: DataFrame, width: str = "1 minute", slide: str | None = None,
                   delay: str = "10 minutes") -> DataFrame:
    """Requests per event-time window x tx x result (tumbling, or sliding when ``slide``)."""
    w = F.window(event_time("ts"), width, slide) if slide else F.window(event_time("ts"), width)
    return (requests.withColumn("_et", event_time("ts")).withWatermark("_et", delay)
            .groupBy(w.alias("w"), "tx", "result").agg(F.count(F.lit(1)).alias("requests"))
            .select(ntz(F.col("w.start")).alias("window_start"), "tx", "result", "requests"))


@register("stream_request_counts", oracle="""
SELECT date_trunc('minute', ts) AS window_start, tx, result, count(*) AS requests FROM requests_v GROUP BY 1, 2, 3""",
          adapters=("requests_v",))
def q_stream_request_counts(spark, d):
    r = requests_v(stream_table(spark, d, "events"))
    return drain_upsert(request_counts(r), "request_counts", ["window_start", "tx", "result"])


@register("stream_request_rate", adapters=("requests_v",), oracle="""
SELECT time_bucket(INTERVAL 15 SECOND, ts) - to_seconds(15 * k) AS window_start, tx,
       round(count(*) / 60.0, 6) AS rate
FROM requests_v, range(0, 4) r(k) GROUP BY 1, 2""")
def q_stream_request_rate(spark, d):
    """ST04: sliding 1-minute request rate per tx, refreshed every 15 seconds."""
    r = requests_v(stream_table(spark, d, "events"))
    w = F.window(event_time("ts"), "1 minute", "15 seconds")
    agg = (r.withColumn("_et", event_time("ts")).withWatermark("_et", "10 minutes")
           .groupBy(w.alias("w"), "tx").agg(F.count(F.lit(1)).alias("n"))
           .select(ntz(F.col("w.start")).alias("window_start"), "tx", F.round(F.col("n") / 60.0, 6).alias("rate")))
    return drain_upsert(agg, "request_rate", ["window_start", "tx"])


# ---- ST08 / ST09 / ST15 money windows -------------------------------------------------------------------

@register("stream_missions", adapters=("money_events_v",), oracle="""
SELECT date_trunc('hour', created_at) AS period, player_id, CAST(-sum(amount) AS DECIMAL(38,2)) AS staked
FROM money_events_v WHERE type = 'stake' GROUP BY 1, 2 HAVING -sum(amount) >= 100""")
def q_stream_missions(spark, d):
    """ST08: hourly mission, one award per (player, hour) once its stakes reach the minimum.

    Over a feed out of order; in append mode an hour is given out once, when the watermark has closed it, and only
    hours that qualify reach the sink.
    """
    stakes = Tables(spark, d).money_events_v.filter(F.col("type") == "stake")
    agg = (feed(stakes, "stakes", "created_at", "id").groupBy(F.window("_et", "1 hour").alias("w"), "player_id")
           .agg((-F.sum("amount")).cast("decimal(38,2)").alias("staked")).filter(F.col("staked") >= 100)
           .select(ntz(F.col("w.start")).alias("period"), "player_id", "staked"))
    return drain_append(agg, "missions")


@register("stream_deposit_alerts", adapters=("money_events_v",), oracle="""
SELECT date_trunc('hour', created_at) - to_hours(k) AS window_start, player_id, count(*) AS deposits,
       CAST(sum(amount) AS DECIMAL(38,2)) AS total
FROM money_events_v, range(0, 24) r(k) WHERE type = 'deposit' GROUP BY 1, 2 HAVING sum(amount) > 200""")
def q_stream_deposit_alerts(spark, d):
    """ST09: deposits over 200 within a sliding 24-hour window (1-hour slide)."""
    m = money_events_v(stream_table(spark, d, "events")).filter(F.col("type") == "deposit")
    agg = (m.withColumn("_et", event_time("created_at")).withWatermark("_et", "1 day")
           .groupBy(F.window("_et", "24 hours", "1 hour").alias("w"), "player_id")
           .agg(F.count(F.lit(1)).alias("deposits"), F.sum("amount").cast("decimal(38,2)").alias("total"))
           .select(ntz(F.col("w.start")).alias("window_start"), "player_id", "deposits", "total"))
    return drain_upsert(agg, "deposit_alerts", ["window_start", "player_id"]).filter(F.col("total") > 200)


@register("stream_leaderboard", adapters=("money_events_v",), oracle="""
WITH p AS (SELECT CAST(date_trunc('week', created_at) AS DATE) AS week, player_id,
                  CAST(round(-sum(amount)) AS BIGINT) AS points
           FROM money_events_v WHERE type = 'stake' GROUP BY 1, 2)
SELECT week, player_id, points, rn AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY points DESC, player_id) AS rn FROM p) WHERE rn <= 100""")
def q_stream_leaderboard(spark, d):
    """ST15: weekly points per player in update mode; a week leaves the state with the watermark, and the
    top 100 per week is cut on read (W05)."""
    m = money_events_v(stream_table(spark, d, "events")).filter(F.col("type") == "stake")
    # the epoch was a Thursday, so windows of a week are moved by four days to begin on Mondays
    agg = (m.withColumn("_et", event_time("created_at")).withWatermark("_et", "1 day")
           .groupBy(F.window("_et", "7 days", "7 days", "4 days").alias("w"), "player_id")
           .agg(F.round(-F.sum("amount")).cast("bigint").alias("points"))
           .select(F.to_date(ntz(F.col("w.start"))).alias("week"), "player_id", "points"))
    table = drain_upsert(agg, "leaderboard", ["week", "player_id"])
    return last_n(table, ["week"], [F.col("points").desc(), F.col("player_id")], 100, rn="position") \
        .withColumn("position", F.col("position").cast("bigint"))


# ---- ST11 / ST12 intake ------------------------------------------------------------------------------------

@register("stream_dedupe_ledger", adapters=("money_events_v",), oracle="""
SELECT DISTINCT 'k' || CAST(id AS VARCHAR) AS idempotency_key, id, player_id, amount, created_at FROM money_events_v""")
def q_stream_dedupe_ledger(spark, d):
    """ST11: idempotent intake: a redelivered row (same key) is dropped within the watermark."""
    src = money_events_v(stream_table(spark, d, "events"))
    dup = money_events_v(stream_table(spark, d, "events")).filter(F.col("id") % 10 == 0)
    rows = src.unionByName(dup).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("idempotency_key"),
                                       "id", "player_id", "amount", "created_at")
    out = (rows.withColumn("_et", event_time("created_at")).withWatermark("_et", "1 hour")
           .dropDuplicatesWithinWatermark(["idempotency_key"]).drop("_et"))
    return drain_append(out, "dedupe_ledger")


@register("stream_expired_requests", adapters=("requests_v",), oracle="""
SELECT event_id, tx, ts, ts + to_seconds(CAST(event_id % 60 AS BIGINT)) AS processed_at FROM requests_v
WHERE event_id % 60 > 30""")
def q_stream_expired_requests(spark, d):
    """ST12: requests processed more than 30 s after they arrived go to the ``expired`` output."""
    r = requests_v(stream_table(spark, d, "events")).withColumn(
        "processed_at", F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 60).cast("decimal(8,6)")))
    late = (F.unix_micros(event_time("processed_at")) - F.unix_micros(event_time("ts"))) > 30_000_000
    return drain_append(r.filter(late).select("event_id", "tx", "ts", "processed_at"), "expired_requests")


# ---- ST06 outage detector (keyed state) -------------------------------------------------------------------

_OUTAGE_OUT = T.StructType([
    T.StructField("target", T.StringType()), T.StructField("outage", T.LongType()),
    T.StructField("start_us", T.LongType()), T.StructField("end_us", T.LongType()),
    T.StructField("last_ok_us", T.LongType()), T.StructField("failed_checks", T.LongType()),
    T.StructField("error", T.StringType())])
_OUTAGE_STATE = T.StructType([
    T.StructField("islands", T.LongType()), T.StructField("open_start", T.LongType()),
    T.StructField("open_failed", T.LongType()), T.StructField("open_error", T.StringType()),
    T.StructField("last_ok", T.LongType())])


def _outage_fold(target, rows: Rows, state: tuple | None, _upto: int):
    """Fold one target's checks, in time order, into its open-outage state: runs of failed checks are
    found by array operations, and only the outages themselves are walked."""
    islands, open_start, open_failed, open_error, last_ok = state or (0, None, 0, None, None)
    n = len(rows)
    if not n:
        return [], state, None
    ts, ok, err = np.asarray(rows["ts_us"]), np.asarray(rows["ok"]).astype(bool), np.asarray(rows["error"])
    before = np.concatenate(([open_start is None], ok[:-1]))
    failed = np.cumsum(~ok)
    ends = np.flatnonzero(ok & ~before).tolist()
    out = []
    for s in [None] * (open_start is not None) + np.flatnonzero(~ok & before).tolist():
        if s is not None:
            islands, open_start, open_error = islands + 1, int(ts[s]), err[s]
            open_failed, last_ok = 1 - int(failed[s]), int(ts[s - 1]) if s else last_ok
        if not ends:
            open_failed += int(failed[-1])
            break
        e = ends.pop(0)
        out.append((target, islands, open_start, int(ts[e]), last_ok, open_failed + int(failed[e]), open_error))
        open_start, open_failed, open_error = None, 0, None
    if ok.any():
        last = int(ts[np.flatnonzero(ok)[-1]])
        last_ok = last if last_ok is None else max(last_ok, last)
    return out, (islands, open_start, open_failed, open_error, last_ok), None


def detect_outages(checks: DataFrame) -> DataFrame:
    """ST06: closed outages per target from a stream of checks (with event time ``_et``); the open one stays in state."""
    error = F.when(F.col("ok"), F.lit(None)).otherwise(F.col("error")).alias("error")  # that of a good check is not read
    c = checks.select("target", "event_id", "ok", error, "_et", F.unix_micros("_et").alias("ts_us"))
    out = in_order(c, "target", ["event_id"], _OUTAGE_OUT, _OUTAGE_STATE, _outage_fold)
    to_ts = lambda col: ntz(F.timestamp_micros(col))
    return out.select("target", "outage", to_ts("start_us").alias("start"), to_ts("end_us").alias("end"),
                      F.round((F.col("end_us") - F.col("start_us")) / 1e6, 3).alias("duration_s"),
                      to_ts("last_ok_us").alias("last_ok"), "failed_checks", "error")


@register("stream_outages", oracle="""WITH c AS (
  SELECT 'db' || CAST(user_id % 4 AS VARCHAR) AS target, ts, event_id AS tie, event_type <> 'error' AS ok, props AS error
  FROM events),
l AS (SELECT *, lag(ok) OVER (PARTITION BY target ORDER BY ts, tie) AS prev_ok FROM c),
s AS (SELECT *, sum(CASE WHEN NOT ok AND coalesce(prev_ok, true) THEN 1 ELSE 0 END)
                 OVER (PARTITION BY target ORDER BY ts, tie ROWS UNBOUNDED PRECEDING) AS island FROM l),
failed AS (SELECT target, island, min(ts) AS start, count(*) AS failed_checks, first(error ORDER BY ts, tie) AS error
           FROM s WHERE NOT ok GROUP BY 1, 2),
oks AS (SELECT target, island, min(ts) AS first_ok, max(ts) AS last_ok_ts FROM s WHERE ok GROUP BY 1, 2)
SELECT f.target, CAST(f.island AS BIGINT) AS outage, f.start, o.first_ok AS "end",
       round(epoch(o.first_ok) - epoch(f.start), 3) AS duration_s, p.last_ok_ts AS last_ok,
       CAST(f.failed_checks AS BIGINT) AS failed_checks, f.error
FROM failed f JOIN oks o ON o.target = f.target AND o.island = f.island
LEFT JOIN oks p ON p.target = f.target AND p.island + 1 = f.island""")
def q_stream_outages(spark, d):
    ev = feed(Tables(spark, d).events, "checks", "ts", "event_id")
    checks = ev.select(F.concat(F.lit("db"), (F.col("user_id") % 4).cast("string")).alias("target"), "_et",
                       "event_id", (F.col("event_type") != "error").alias("ok"), F.col("props").alias("error"))
    return drain_append(detect_outages(checks), "outages")


# ---- ST10 change capture -> status history (keyed state) ------------------------------------------------

_CDC_OUT = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()),
                         T.StructField("ts_us", T.LongType()), T.StructField("from_status", T.StringType()),
                         T.StructField("to_status", T.StringType())])
_CDC_STATE = T.StructType([T.StructField("last_status", T.StringType())])


def _cdc_fold(user_id, rows: Rows, state: tuple | None, _upto: int):
    status = np.asarray(rows["event_type"])
    if not len(status):
        return [], state, None
    before = np.concatenate((np.array([state[0] if state else None], dtype=object), status[:-1]))
    moved = np.flatnonzero(before != status)
    out = zip([user_id] * len(moved), rows["event_id"][moved].tolist(), rows["ts_us"][moved].tolist(),
              before[moved].tolist(), status[moved].tolist(), strict=True)
    return list(out), (str(status[-1]),), None


def status_changes(changes: DataFrame) -> DataFrame:
    """ST10: status history from a change stream (event time ``_et``): keyed state holds the last status."""
    c = changes.select("user_id", "event_id", "event_type", "_et", F.unix_micros("_et").alias("ts_us"))
    out = in_order(c, "user_id", ["event_id"], _CDC_OUT, _CDC_STATE, _cdc_fold)
    return out.select("user_id", "event_id", ntz(F.timestamp_micros("ts_us")).alias("ts"), "from_status",
                      "to_status")


@register("stream_status_changes", oracle="""
SELECT user_id, event_id, ts, from_status, event_type AS to_status FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_status FROM events)
WHERE from_status IS DISTINCT FROM event_type""")
def q_stream_status_changes(spark, d):
    changes = Tables(spark, d).events.select("user_id", "event_id", "event_type", "ts")
    return drain_append(status_changes(feed(changes, "changes", "ts", "event_id")), "status_changes")


# ---- ST05 streaming latency quantiles ------------------------------------------------------------------

def latency_histograms(requests: DataFrame, delay: str = "2 hours") -> DataFrame:
    """ST05: hourly cumulative latency histograms per tx of a stream; an hour leaves the state with the watermark, which
    is ``delay`` behind unless the stream has one on ``_et``."""
    r = requests if "_et" in requests.columns else requests.withColumn("_et", event_time("ts")).withWatermark("_et", delay)
    h = histogram(r.withColumn("w", F.window("_et", "1 hour")), F.col("latency_ms").cast("double") / 1000, ["w", "tx"], LATENCY_BUCKETS)
    return h.withColumn("hour", ntz(F.col("w.start"))).drop("w")


def latency_quantiles(table: DataFrame, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """p50, p95 and p99 of every hour and tx, read off the histograms (Q05)."""
    out = histogram_quantile(table, quantiles[0], ["hour", "tx"])
    for q in quantiles[1:]:
        out = out.unionByName(histogram_quantile(table, q, ["hour", "tx"]))
    return out


def _latency_oracle(quantiles: tuple[float, ...]) -> str:
    bounds = ", ".join(f"({i}, {b})" for i, b in enumerate((*LATENCY_BUCKETS, "NULL")))
    asked = ", ".join(f"({q})" for q in quantiles)
    return f"""WITH h AS (
  SELECT date_trunc('hour', r.ts) AS hour, r.tx, b.bucket, CAST(b.upper AS DOUBLE) AS upper,
         count(*) FILTER (WHERE b.upper IS NULL OR CAST(r.latency_ms AS DOUBLE) / 1000 <= b.upper) AS cumulative
  FROM requests_v r, (VALUES {bounds}) b(bucket, upper) GROUP BY 1, 2, 3, 4),
b AS (SELECT *, coalesce(lag(cumulative) OVER (PARTITION BY hour, tx ORDER BY bucket), 0) AS prev_cum,
             coalesce(lag(upper) OVER (PARTITION BY hour, tx ORDER BY bucket), 0.0) AS lower,
             max(cumulative) OVER (PARTITION BY hour, tx) AS total FROM h),
hit AS (SELECT b.*, CAST(q AS DOUBLE) AS q, CAST(q AS DOUBLE) * total AS rnk, row_number() OVER (PARTITION BY hour, tx, q ORDER BY bucket) AS k
        FROM b, (VALUES {asked}) a(q) WHERE total > 0 AND cumulative >= CAST(q AS DOUBLE) * total)
SELECT hour, tx, q, round(CASE WHEN upper IS NULL THEN lower ELSE lower + (upper - lower) * (rnk - prev_cum) / (cumulative - prev_cum) END, 6) AS quantile
FROM hit WHERE k = 1"""


@register("stream_latency_p95", adapters=("requests_v",), oracle=_latency_oracle((0.95,)))
def q_stream_latency_p95(spark, d):
    table = drain_upsert(latency_histograms(requests_v(stream_table(spark, d, "events"))), "latency_hist", ["hour", "tx", "bucket"])
    return latency_quantiles(table, (0.95,))


@register("stream_latency_quantiles", adapters=("requests_v",), oracle=_latency_oracle((0.5, 0.95, 0.99)))
def q_stream_latency_quantiles(spark, d):
    """ST05 over a feed of several files out of order."""
    requests = feed(Tables(spark, d).requests_v, "latencies", "ts", "event_id")
    table = drain_upsert(latency_histograms(requests), "latency-quantiles", ["hour", "tx", "bucket"])
    return latency_quantiles(table)


# ---- ST02 match state machine (keyed state, event-time timers) ---------------------------------------

MATCH_SECONDS = 900       # full time after kick-off (feed default)
SUSPEND_SECONDS = 15      # markets suspended after a goal
# Fixed mapping of the driver events to feed actions.
FEED_ACTIONS = {"signup": "kickoff", "purchase": "goal_home", "click": "goal_away"}

_MATCH_OUT = T.StructType([
    T.StructField("match_id", T.LongType()), T.StructField("version", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("home_score", T.IntegerType()),
    T.StructField("away_score", T.IntegerType()), T.StructField("kicked_us", T.LongType()),
    T.StructField("finished_us", T.LongType()), T.StructField("suspended_until_us", T.LongType())])
_MATCH_STATE = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("home", T.IntegerType()), T.StructField("away", T.IntegerType()),
    T.StructField("kicked_us", T.LongType()), T.StructField("finished_us", T.LongType()),
    T.StructField("suspended_until_us", T.LongType()), T.StructField("version", T.LongType())])


def _match_fold(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One match's actions in event-time order: kick-off -> live; a goal while live scores and
    suspends the markets for 15 s; full time 900 s after kick-off closes the match; actions on
    a match that is not live are ignored. A timeout (watermark past full time) finishes it."""
    match_id = key[0]
    status, home, away, kicked, finished, susp, version = (
        state.get if state.exists else ("scheduled", 0, 0, None, None, None, 0))
    if state.hasTimedOut:
        if status == "live":
            status, finished = "finished", kicked + MATCH_SECONDS * 1_000_000
    else:
        batch = pd.concat(list(pdfs), ignore_index=True).sort_values(["ts_us", "event_id"], kind="mergesort")
        for t, action in zip(batch["ts_us"].to_numpy(), batch["action"].to_numpy()):
            t = int(t)
            if status == "live" and t >= kicked + MATCH_SECONDS * 1_000_000:
                status, finished = "finished", kicked + MATCH_SECONDS * 1_000_000
            if action == "kickoff" and status == "scheduled":
                status, kicked = "live", t
            elif action in ("goal_home", "goal_away") and status == "live":
                home, away = (home + 1, away) if action == "goal_home" else (home, away + 1)
                susp = t + SUSPEND_SECONDS * 1_000_000
    version += 1  # one snapshot a call, so no two have the same version
    state.update((status, home, away, kicked, finished, susp, version))
    if status == "live":
        state.setTimeoutTimestamp((kicked + MATCH_SECONDS * 1_000_000) // 1000)
    yield pd.DataFrame([(match_id, version, status, home, away, kicked, finished, susp)],
                       columns=[f.name for f in _MATCH_OUT.fields])


def match_states(actions: DataFrame, as_of: str) -> DataFrame:
    """ST02: the match state machine as a keyed stateful stream; the snapshot table keeps the
    newest state per match, and full time is also applied at read time for ``as_of``."""
    a = (actions.withColumn("_et", event_time("ts")).withWatermark("_et", "1 hour")
         .select("match_id", "event_id", "action", "_et", F.unix_micros("_et").alias("ts_us")))
    out = a.groupBy("match_id").applyInPandasWithState(_match_fold, _MATCH_OUT, _MATCH_STATE, "append",
                                                       GroupStateTimeout.EventTimeTimeout)
    return out


def _actions(ev: DataFrame) -> DataFrame:
    m = F.create_map(*[x for k, v in FEED_ACTIONS.items() for x in (F.lit(k), F.lit(v))])
    return ev.select(F.col("user_id").alias("match_id"), "event_id", "ts",
                     F.element_at(m, F.col("event_type")).alias("action")).filter(F.col("action").isNotNull())


@register("stream_match_states", oracle="""
WITH k AS (SELECT user_id AS match_id, arg_min(event_id, (ts, event_id)) AS kick_id, min(ts) AS kicked_off_at
           FROM events WHERE event_type = 'signup' GROUP BY 1),
g AS (SELECT k.match_id,
             count(*) FILTER (WHERE e.event_type = 'purchase') AS home_score,
             count(*) FILTER (WHERE e.event_type = 'click') AS away_score
      FROM k JOIN events e ON e.user_id = k.match_id AND e.event_type IN ('purchase', 'click')
       AND (e.ts > k.kicked_off_at OR (e.ts = k.kicked_off_at AND e.event_id > k.kick_id))
       AND e.ts < k.kicked_off_at + INTERVAL 900 SECOND
      GROUP BY 1),
m AS (SELECT DISTINCT user_id AS match_id FROM events WHERE event_type IN ('signup', 'purchase', 'click'))
SELECT m.match_id,
       CASE WHEN k.match_id IS NULL THEN 'scheduled'
            WHEN k.kicked_off_at + INTERVAL 900 SECOND <= TIMESTAMP '2024-01-31 00:00:00' THEN 'finished' ELSE 'live' END AS status,
       CAST(coalesce(g.home_score, 0) AS INT) AS home_score, CAST(coalesce(g.away_score, 0) AS INT) AS away_score,
       k.kicked_off_at,
       CASE WHEN k.kicked_off_at + INTERVAL 900 SECOND <= TIMESTAMP '2024-01-31 00:00:00'
            THEN k.kicked_off_at + INTERVAL 900 SECOND END AS finished_at
FROM m LEFT JOIN k ON k.match_id = m.match_id LEFT JOIN g ON g.match_id = m.match_id""")
def q_stream_match_states(spark, d):
    from tillbook.session import EVENTS_AS_OF

    ev = stream_table(spark, d, "events")
    snaps = drain_append(match_states(_actions(ev), EVENTS_AS_OF), "match_states")
    latest = snaps.groupBy("match_id").agg(F.max_by(F.struct(*[c for c in snaps.columns if c != "match_id"]),
                                                    F.col("version")).alias("s")).select("match_id", "s.*")
    full_time = F.col("kicked_us") + F.lit(MATCH_SECONDS * 1_000_000)
    now_us = F.unix_micros(F.lit(EVENTS_AS_OF).cast("timestamp"))
    done = (F.col("status") == "live") & (full_time <= now_us)
    to_ts = lambda c: ntz(F.timestamp_micros(c))
    return latest.select(
        "match_id", F.when(done, F.lit("finished")).otherwise(F.col("status")).alias("status"),
        "home_score", "away_score", to_ts("kicked_us").alias("kicked_off_at"),
        to_ts(F.when(done, full_time).otherwise(F.col("finished_us"))).alias("finished_at"))


# ---- ST14 wallet stream: sequential accept / refuse per player ------------------------------------------

_WALLET_OUT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("player_id", T.LongType()), T.StructField("type", T.StringType()),
    T.StructField("cents", T.LongType()), T.StructField("result", T.StringType()),
    T.StructField("balance_cents", T.LongType()), T.StructField("staked_cents", T.LongType())])
_WALLET_STATE = T.StructType([T.StructField("balance", T.LongType()), T.StructField("day", T.LongType()),
                              T.StructField("staked", T.LongType())])
_DAY_US = 86_400_000_000


def _wallet_fold(player_id, rows: Rows, state: tuple | None, _upto: int):
    """A player's cash requests in order, in cents: credits always apply; a debit that would take the
    balance below zero is refused (insufficient_funds), then a stake that would take the day's accepted
    stakes beyond the daily limit (limit_reached). A refused request changes nothing."""
    balance, day, staked = state or (0, 0, 0)
    out = []
    limits = [None if pd.isna(x) else int(x) for x in rows["limit_cents"]]
    for rid, typ, cents, at, limit in zip(rows["id"].tolist(), rows["type"].tolist(), rows["cents"].tolist(), rows["ts_us"].tolist(),
                                          limits, strict=True):
        if at // _DAY_US != day:
            day, staked = at // _DAY_US, 0
        result = "ok"
        if cents < 0 and balance + cents < 0:
            result = "insufficient_funds"
        elif typ == "stake" and limit is not None and staked - cents > limit:
            result = "limit_reached"
        else:
            balance += cents
            staked -= cents if typ == "stake" else 0
        out.append((rid, player_id, typ, cents, result, balance, staked))
    return out, (balance, day, staked), None


def wallet_stream(ledger: DataFrame) -> DataFrame:
    """ST14: running wallet with admission, keyed by player; the state is the balance, the day and
    what the player has staked on it. ``ledger`` has event time ``_et`` and daily_loss_limit (null: none)."""
    cents = lambda c: (F.col(c) * 100).cast("bigint")
    c = ledger.filter(F.col("account") == "cash").select(
        "id", "player_id", "type", cents("amount").alias("cents"), cents("daily_loss_limit").alias("limit_cents"), "_et",
        F.unix_micros("_et").alias("ts_us"))
    out = in_order(c, "player_id", ["id"], _WALLET_OUT, _WALLET_STATE, _wallet_fold)
    money = lambda c: (F.col(c).cast("decimal(16,2)") / 100).cast("decimal(14,2)")
    return out.select("id", "player_id", "type", money("cents").alias("amount"), "result", money("balance_cents").alias("balance_after"),
                      money("staked_cents").alias("staked_today"))


def _wallet_oracle(limit: str) -> str:
    """A recursive walk over each player's requests; ``limit`` is an SQL expression."""
    refused = "j.amount < 0 AND w.balance_after + j.amount < 0"
    today = "CASE WHEN CAST(j.created_at AS DATE) = w.day THEN w.staked_today ELSE CAST(0 AS DECIMAL(14,2)) END"
    over = f"j.type = 'stake' AND j.lim IS NOT NULL AND {today} - j.amount > j.lim"
    return f"""WITH RECURSIVE j AS (
  SELECT id, player_id, type, amount, created_at, {limit} AS lim,
         row_number() OVER (PARTITION BY player_id ORDER BY created_at, id) AS rn
  FROM money_events_v m LEFT JOIN (SELECT id AS pid, daily_loss_limit FROM players_v) p ON p.pid = m.player_id WHERE account = 'cash'),
walk AS (
  SELECT player_id, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS id, '' AS type, CAST(0 AS DECIMAL(14,2)) AS amount, '' AS result,
         CAST(0 AS DECIMAL(14,2)) AS balance_after, DATE '1970-01-01' AS day, CAST(0 AS DECIMAL(14,2)) AS staked_today
  FROM (SELECT DISTINCT player_id FROM j)
  UNION ALL
  SELECT j.player_id, j.rn, j.id, j.type, j.amount,
         CASE WHEN {refused} THEN 'insufficient_funds' WHEN {over} THEN 'limit_reached' ELSE 'ok' END,
         CAST(CASE WHEN ({refused}) OR ({over}) THEN w.balance_after ELSE w.balance_after + j.amount END AS DECIMAL(14,2)),
         CAST(j.created_at AS DATE),
         CAST({today} - CASE WHEN j.type = 'stake' AND NOT ({refused}) AND NOT ({over}) THEN j.amount ELSE 0 END AS DECIMAL(14,2))
  FROM walk w JOIN j ON j.player_id = w.player_id AND j.rn = w.rn + 1)
"""


def _wallets(spark, d, limited: bool) -> DataFrame:
    t = Tables(spark, d)
    ledger = feed(t.money_events_v, "ledger", "created_at", "id")
    if not limited:
        return drain_append(wallet_stream(ledger.withColumn("daily_loss_limit", F.lit(None).cast("decimal(12,2)"))), "wallets")
    limits = t.players_v.select(F.col("id").alias("player_id"), "daily_loss_limit")
    return drain_append(wallet_stream(ledger.join(limits, "player_id", "left")), "wallet-days")


@register("stream_wallets", adapters=("money_events_v", "players_v"), oracle=_wallet_oracle("CAST(NULL AS DECIMAL(12,2))") + """
SELECT id, player_id, type, amount, result, balance_after FROM walk WHERE rn > 0""")
def q_stream_wallets(spark, d):
    return _wallets(spark, d, False).drop("staked_today")


@register("stream_wallet_days", adapters=("money_events_v", "players_v"), oracle=_wallet_oracle("daily_loss_limit") + """
SELECT id, player_id, type, amount, result, balance_after, staked_today FROM walk WHERE rn > 0""")
def q_stream_wallet_days(spark, d):
    """ST14 with the player's daily limit on stakes."""
    return _wallets(spark, d, True)


# ---- ST16 settlement trigger ------------------------------------------------------------------------------

def settlement_stream(updates: DataFrame, matches: DataFrame, bets: DataFrame, legs: DataFrame) -> DataFrame:
    """ST16: bet outcomes of every micro-batch of match updates.

    The finished matches of each micro-batch are kept in a folder per batch id (a replay overwrites
    its own). The state of a batch is the match table with all finished matches so far, those of
    earlier batches as settled; the batch only chooses which matches are settled now. So a bet
    whose legs finish in different batches stays open until the last of them.
    """
    from tillbook.plans.book_jobs import settle

    spark = updates.sparkSession
    folder = scratch_path(spark, "streams/finished-matches")
    kept = T.StructType([*updates.schema.fields, T.StructField("batch", T.LongType())])

    def run(update: DataFrame, batch_id: int) -> DataFrame:
        update.filter(F.col("status") == "finished").write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        rows = spark.read.schema(kept).parquet(folder).filter(F.col("batch") <= batch_id)
        first = rows.groupBy("id").agg(F.min_by(F.struct(*[c for c in update.columns if c != "id"]), "batch").alias("r"),
                                       F.min("batch").alias("batch"))
        ended = first.select("id", "r.*", "batch").withColumn(
            "status", F.when(F.col("batch") < batch_id, "settled").otherwise(F.col("status")))
        state = matches.join(ended.select("id"), "id", "left_anti").unionByName(ended.select(*matches.columns))
        return settle(state, bets, legs, None, ended.filter(F.col("batch") == batch_id).select("id"))[0]

    schema = T.StructType([T.StructField("bet_id", T.LongType()), T.StructField("player_id", T.LongType()),
                           T.StructField("status", T.StringType()), T.StructField("payout", T.DecimalType(14, 2))])
    return drain_batches(updates, "settlement", run, schema)


@register("stream_settlement", adapters=("matches_v", "legs_v", "bets_v"), oracle="""
WITH batch AS (SELECT id AS m_id FROM matches_v WHERE status = 'finished'),
lr AS (
  SELECT l.bet_id, l.odds, m.status AS mstatus, bt.m_id,
         CASE WHEN (l.outcome = 1 AND m.home_score > m.away_score) OR (l.outcome = 2 AND m.home_score = m.away_score)
                OR (l.outcome = 3 AND m.home_score < m.away_score) OR (l.outcome = 4 AND m.home_score + m.away_score > 2)
                OR (l.outcome = 5 AND m.home_score + m.away_score < 3)
                OR (l.outcome = 6 AND m.home_score > 0 AND m.away_score > 0)
                OR (l.outcome = 7 AND (m.home_score = 0 OR m.away_score = 0)) THEN 'won' ELSE 'lost' END AS res
  FROM legs_v l JOIN matches_v m ON m.id = l.event_id LEFT JOIN batch bt ON bt.m_id = l.event_id),
per AS (
  SELECT bet_id,
         count(*) FILTER (WHERE (mstatus = 'settled' OR m_id IS NOT NULL) AND res = 'lost') AS lost,
         count(*) FILTER (WHERE NOT (mstatus = 'settled' OR m_id IS NOT NULL)) AS waiting,
         count(*) FILTER (WHERE mstatus = 'settled' AND res = 'lost') AS lost_before,
         CAST(round_even(least(list_reduce(list(CAST(odds AS DECIMAL(28,12))),
                         lambda a, b: CAST(a * b AS DECIMAL(28,12))), 1000), 3) AS DECIMAL(10,3)) AS total_odds
  FROM lr WHERE bet_id IN (SELECT bet_id FROM lr WHERE m_id IS NOT NULL) GROUP BY bet_id)
SELECT p.bet_id, b.player_id,
       CASE WHEN lost > 0 THEN 'lost' WHEN waiting = 0 THEN 'won' ELSE 'open' END AS status,
       CASE WHEN lost > 0 THEN CAST(0 AS DECIMAL(14,2)) WHEN waiting = 0
            THEN CAST(round_even(b.stake * p.total_odds, 2) AS DECIMAL(14,2)) END AS payout
FROM per p JOIN bets_v b ON b.id = p.bet_id WHERE lost_before = 0""")
def q_stream_settlement(spark, d):
    """ST16: each micro-batch of match updates settles all finished matches it brings."""
    from tillbook.sources.adapters import matches_v

    t = Tables(spark, d)
    return settlement_stream(matches_v(stream_table(spark, d, "part")), t.matches_v, t.bets_v, t.legs_v)
