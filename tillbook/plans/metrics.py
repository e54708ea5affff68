"""Registered metric queries (Q01-Q11) over counters, histograms and probe checks derived from
the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillbook.functions import LATENCY_BUCKETS, ts_lit
from tillbook.operators import metrics as M
from tillbook.plans.locks import CHAIN_SQL, _chains, sessions_from_samples, who_waits
from tillbook.plans.registry import register
from tillbook.session import EVENTS_AS_OF
from tillbook.sources.adapters import Tables


def _tx_counters(t: Tables):
    return M.counter_samples(t.requests_v, "tx_total", ["tx", "result"])


_COUNTERS_SQL = """WITH c AS (
  SELECT ts, event_id, tx, result,
         CAST(count(*) OVER (PARTITION BY tx, result, date_trunc('day', ts) ORDER BY ts, event_id
                             ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value
  FROM requests_v),
d AS (SELECT *, lag(value) OVER (PARTITION BY tx, result ORDER BY ts, event_id) AS prev FROM c),
e AS (SELECT *, CASE WHEN prev IS NULL THEN value WHEN value < prev THEN value ELSE value - prev END AS delta FROM d)
"""


@register("request_rate", adapters=("requests_v",), oracle=_COUNTERS_SQL + """
SELECT date_trunc('hour', ts) AS window, tx, round(sum(delta) / 3600.0, 6) AS rate FROM e GROUP BY 1, 2""")
def q_request_rate(spark, d):
    """Q01: sum by (tx) (rate(tx_total[1h])) with counter resets."""
    return M.rate(_tx_counters(Tables(spark, d)), 3600, ["tx"])


@register("error_increase_daily", adapters=("requests_v",), oracle=_COUNTERS_SQL + """
SELECT date_trunc('day', ts) AS window, result, round(sum(delta)) AS increase FROM e
WHERE NOT regexp_full_match(result, 'ok|out_of_stock') GROUP BY 1, 2""")
def q_error_increase_daily(spark, d):
    """Q02 + Q03: round(increase(tx_total{result!~"ok|out_of_stock"}[1d])) by result."""
    s = M.match(_tx_counters(Tables(spark, d)), {"result": ("!~", "ok|out_of_stock")})
    return M.increase(s, 86400, ["result"]).withColumn("increase", F.round("increase"))


_BUCKETS_VALUES = ", ".join(
    [f"({i}, '{repr(float(b))}', CAST({b} AS DOUBLE))" for i, b in enumerate(LATENCY_BUCKETS)]
    + [f"({len(LATENCY_BUCKETS)}, '+Inf', CAST(NULL AS DOUBLE))"])
_HIST_SQL = f"""WITH h AS (
  SELECT r.tx, b.bucket, b.le, b.upper,
         count(*) FILTER (WHERE b.upper IS NULL OR CAST(r.latency_ms AS DOUBLE) / 1000 <= b.upper) AS cumulative
  FROM requests_v r, (VALUES {_BUCKETS_VALUES}) b(bucket, le, upper)
  GROUP BY 1, 2, 3, 4)
"""


def _latency_hist(t: Tables):
    return M.histogram(t.requests_v, F.col("latency_ms").cast("double") / 1000, ["tx"])


@register("latency_histogram", adapters=("requests_v",), oracle=_HIST_SQL + "SELECT * FROM h")
def q_latency_histogram(spark, d):
    """Q04: cumulative latency histogram per transaction (12 bounds + Inf)."""
    return _latency_hist(Tables(spark, d))


@register("latency_p95", adapters=("requests_v",), oracle=_HIST_SQL + """,
b AS (SELECT *, coalesce(lag(cumulative) OVER (PARTITION BY tx ORDER BY bucket), 0) AS prev_cum,
             coalesce(lag(upper) OVER (PARTITION BY tx ORDER BY bucket), 0.0) AS lower,
             max(cumulative) OVER (PARTITION BY tx) AS total FROM h),
hit AS (SELECT *, 0.95 * total AS rnk, row_number() OVER (PARTITION BY tx ORDER BY bucket) AS k
        FROM b WHERE total > 0 AND cumulative >= 0.95 * total)
SELECT g.tx, round(CASE WHEN hit.upper IS NULL THEN hit.lower
                  ELSE hit.lower + (hit.upper - hit.lower) * (hit.rnk - hit.prev_cum) / (hit.cumulative - hit.prev_cum) END, 6)
       AS quantile, CAST(0.95 AS DOUBLE) AS q
FROM (SELECT DISTINCT tx FROM h) g LEFT JOIN hit ON hit.tx = g.tx AND hit.k = 1""")
def q_latency_p95(spark, d):
    """Q05: histogram_quantile(0.95, sum by (le, tx) (...))."""
    return M.histogram_quantile(_latency_hist(Tables(spark, d)), 0.95, ["tx"])


def _checks(t: Tables):
    e = t.events
    return e.select(F.concat(F.lit("db"), (F.col("user_id") % 4).cast("string")).alias("target"), "ts", "event_id",
                    (F.col("event_type") != "error").alias("ok"), F.col("props").alias("error"))


_CHECKS_SQL = """WITH c AS (
  SELECT 'db' || CAST(user_id % 4 AS VARCHAR) AS target, ts, event_id AS tie, event_type <> 'error' AS ok, props AS error
  FROM events),
l AS (SELECT *, lag(ok) OVER (PARTITION BY target ORDER BY ts, tie) AS prev_ok FROM c),
s AS (SELECT *, sum(CASE WHEN NOT ok AND coalesce(prev_ok, true) THEN 1 ELSE 0 END)
                 OVER (PARTITION BY target ORDER BY ts, tie ROWS UNBOUNDED PRECEDING) AS island FROM l),
failed AS (SELECT target, island, min(ts) AS start, count(*) AS failed_checks, first(error ORDER BY ts, tie) AS error
           FROM s WHERE NOT ok GROUP BY 1, 2),
oks AS (SELECT target, island, min(ts) AS first_ok, max(ts) AS last_ok_ts FROM s WHERE ok GROUP BY 1, 2),
outages AS (
  SELECT f.target, CAST(f.island AS BIGINT) AS outage, f.start, o.first_ok AS "end",
         round(epoch(o.first_ok) - epoch(f.start), 3) AS duration_s, p.last_ok_ts AS last_ok,
         CAST(f.failed_checks AS BIGINT) AS failed_checks, f.error, o.first_ok IS NULL AS open
  FROM failed f LEFT JOIN oks o ON o.target = f.target AND o.island = f.island
  LEFT JOIN oks p ON p.target = f.target AND p.island + 1 = f.island)
"""


@register("outages", oracle=_CHECKS_SQL + "SELECT * FROM outages")
def q_outages(spark, d):
    """Q07: outage intervals per target from probe checks."""
    return M.outages(_checks(Tables(spark, d)))


@register("availability", oracle=_CHECKS_SQL + """,
up AS (SELECT target, CAST(first(ok ORDER BY ts DESC, tie DESC) AS INT) AS up FROM c
       WHERE ts <= TIMESTAMP '2024-01-31 00:00:00' GROUP BY 1),
o AS (SELECT *, coalesce("end", TIMESTAMP '2024-01-31 00:00:00') AS e2 FROM outages),
per AS (
  SELECT target,
         round(sum(CASE WHEN start < TIMESTAMP '2024-01-20 00:00:00' AND e2 > TIMESTAMP '2024-01-10 00:00:00'
                   THEN epoch(least(e2, TIMESTAMP '2024-01-20 00:00:00')) - epoch(greatest(start, TIMESTAMP '2024-01-10 00:00:00'))
                   ELSE 0.0 END), 3) AS downtime_s,
         count(*) FILTER (WHERE start < TIMESTAMP '2024-01-20 00:00:00' AND e2 > TIMESTAMP '2024-01-10 00:00:00') AS outages,
         round(max(CASE WHEN "end" IS NULL THEN epoch(TIMESTAMP '2024-01-31 00:00:00') - epoch(start) END), 3) AS ongoing_s
  FROM o GROUP BY 1)
SELECT up.target, up.up, coalesce(per.ongoing_s, 0.0) AS current_outage_s, coalesce(per.downtime_s, 0.0) AS downtime_s,
       CAST(coalesce(per.outages, 0) AS BIGINT) AS outages
FROM up LEFT JOIN per ON per.target = up.target""")
def q_availability(spark, d):
    """Q08: up now, ongoing outage, downtime and outage count per target in 2024-01-10..20."""
    t = Tables(spark, d)
    checks = _checks(t)
    return M.availability(checks, M.outages(checks), ts_lit("2024-01-10 00:00:00"), ts_lit("2024-01-20 00:00:00"),
                          ts_lit(EVENTS_AS_OF))


@register("up_timeline", oracle="""WITH c AS (
  SELECT 'db' || CAST(user_id % 4 AS VARCHAR) AS target, ts, event_id AS tie, CAST(event_type <> 'error' AS INT) AS v
  FROM events),
l AS (SELECT *, lag(v) OVER (PARTITION BY target ORDER BY ts, tie) AS pv FROM c),
ch AS (SELECT * FROM l WHERE pv IS DISTINCT FROM v)
SELECT target, ts AS start, lead(ts) OVER (PARTITION BY target ORDER BY ts, tie) AS "end", v AS value,
       CASE v WHEN 0 THEN 'DOWN' WHEN 1 THEN 'UP' END AS state FROM ch""")
def q_up_timeline(spark, d):
    """Q10: UP/DOWN state timeline per target (value mapping 0 -> DOWN, 1 -> UP)."""
    c = _checks(Tables(spark, d))
    return M.state_timeline(c, "target", "ts", "event_id", F.col("ok").cast("int"), {0: "DOWN", 1: "UP"})


@register("job_stats", adapters=("shipments_v",), oracle="""WITH r AS (
  SELECT 'carrier-' || CAST(carrier_id AS VARCHAR) AS job_name, id AS run_id, shipped_at AS started_at,
         delivered_at AS finished_at, CASE WHEN delivered_at IS NULL THEN 'running' ELSE 'ok' END AS result
  FROM shipments_v),
l AS (SELECT *, lag(finished_at) OVER (PARTITION BY job_name ORDER BY started_at, run_id) AS prev FROM r)
SELECT job_name, count(*) FILTER (WHERE result = 'ok') AS ok_runs, count(*) FILTER (WHERE result <> 'ok') AS other_runs,
       round(first(epoch(finished_at) - epoch(started_at) ORDER BY started_at DESC, run_id DESC), 3) AS last_duration_s,
       count(*) FILTER (WHERE prev IS NOT NULL AND started_at < prev) AS overlaps
FROM l GROUP BY 1""")
def q_job_stats(spark, d):
    """Q11: runs by result, last duration and overlapping runs per job."""
    s = Tables(spark, d).shipments_v
    runs = s.select(F.concat(F.lit("carrier-"), F.col("carrier_id").cast("string")).alias("job_name"),
                    F.col("id").alias("run_id"), F.col("shipped_at").alias("started_at"),
                    F.col("delivered_at").alias("finished_at"),
                    F.when(F.col("delivered_at").isNull(), "running").otherwise("ok").alias("result"))
    return M.job_stats(runs)


@register("instant_up", oracle="""
SELECT 'db' || CAST(user_id % 4 AS VARCHAR) AS target,
       CAST(first(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END ORDER BY ts DESC, event_id DESC) AS DOUBLE) AS value
FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1""")
def q_instant_up(spark, d):
    """Q06: min by (target) of the latest ``up`` sample at an instant."""
    c = _checks(Tables(spark, d))
    samples = c.select("ts", F.col("event_id").alias("sample_id"), F.lit("up").alias("metric"),
                       F.create_map(F.lit("target"), F.col("target")).alias("labels"),
                       F.col("ok").cast("double").alias("value"))
    return M.agg_by(M.latest(samples, ts_lit("2024-01-15 12:00:00")), "min", ["target"])


@register("blocked_session_seconds", adapters=("session_samples_v",), oracle=CHAIN_SQL + """
SELECT s.blocking_user AS waiting_user, 5.0 * count(DISTINCT (h.sample, h.waiting_pid)) FILTER (WHERE h.waiting_pid IS NOT NULL) AS sum_over_time
FROM sess s LEFT JOIN held h ON h.sample = s.sample AND h.waiting_pid = s.pid WHERE blocker_pid IS NOT NULL GROUP BY 1""")
def q_blocked_session_seconds(spark, d):
    """Q09: sum_over_time(blocked sessions) x 5 s resolution, per waiting user."""
    t = Tables(spark, d)
    ww = who_waits(_chains(t), sessions_from_samples(t.session_samples_v))
    return M.over_time(ww, "blocked_sessions", ["waiting_user"], "sum", 5.0)


@register("blocked_session_peak", adapters=("session_samples_v",), oracle=CHAIN_SQL + """,
n AS (SELECT s.sample, datname, s.blocking_user AS waiting_user, app,
             count(*) FILTER (WHERE EXISTS (SELECT 1 FROM held h WHERE h.sample = s.sample AND h.waiting_pid = s.pid)) AS blocked
      FROM sess s WHERE blocker_pid IS NOT NULL GROUP BY ALL)
SELECT waiting_user, CAST(max(blocked) AS DOUBLE) AS max_over_time FROM n GROUP BY 1""")
def q_blocked_session_peak(spark, d):
    """Q09: max_over_time(blocked sessions) per waiting user."""
    t = Tables(spark, d)
    ww = who_waits(_chains(t), sessions_from_samples(t.session_samples_v))
    return M.over_time(ww, "blocked_sessions", ["waiting_user"], "max", 1.0)


@register("instant_aggregates", oracle="""
WITH s AS (SELECT user_id % 7 AS job, user_id % 3 AS host, arg_max(value, (ts, event_id)) AS v
           FROM events WHERE event_type <> 'error' GROUP BY ALL),
a AS (SELECT 'sum' AS fn, job, sum(v) AS value FROM s GROUP BY job UNION ALL SELECT 'max', job, max(v) FROM s GROUP BY job
      UNION ALL SELECT 'min', job, min(v) FROM s GROUP BY job)
SELECT fn, CAST(job AS VARCHAR) AS job, round(value, 6) AS value, row_number() OVER (PARTITION BY fn ORDER BY round(value, 6) DESC, CAST(job AS VARCHAR)) AS place
FROM a WHERE value > 0
UNION ALL SELECT 'absent', NULL, 0.0, 1""")
def q_instant_aggregates(spark, d):
    """Q06: ``sort_desc(fn by (job) (gauge) > 0)`` for sum, max and min of the latest samples, and ``sum(absent) or vector(0)``."""
    ev = Tables(spark, d).events.filter(F.col("event_type") != "error")
    samples = ev.select("ts", F.col("event_id").alias("sample_id"), F.lit("gauge").alias("metric"),
                        F.create_map(F.lit("job"), (F.col("user_id") % 7).cast("string"), F.lit("host"), (F.col("user_id") % 3).cast("string"))
                        .alias("labels"), "value")
    last = M.latest(samples)
    out = M.agg_by(samples.filter(F.col("metric") == "absent"), "sum", []).select(
        F.lit("absent").alias("fn"), F.lit(None).cast("string").alias("job"), "value", F.lit(1).cast("bigint").alias("place"))
    for fn in ("sum", "max", "min"):
        g = M.agg_by(last, fn, ["job"]).withColumn("value", F.round("value", 6)).filter(F.col("value") > 0)
        out = out.unionByName(M.sort_desc(g, ["job"]).withColumn("fn", F.lit(fn)))
    return out
