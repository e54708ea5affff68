"""Lock-blocking analysis (L01-L05) over session samples: waits-for edges, root-blocker chains,
who blocks, what they run, who waits.

Each sample is an independent graph; every operator keys by the sample, so samples spread
over the cluster and the closure loop (J11) runs all samples in the same rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import seconds_between
from tillbook.operators.joins import transitive_closure
from tillbook.plans.registry import register
from tillbook.sources.adapters import Tables


def sessions_from_samples(samples: DataFrame) -> DataFrame:
    """Sessions of each sample: database, user, application, backend type, state and times of the transaction and
    the state, ``blocking_pids`` as an array (empty when not waiting) and a statement text.

    Some sessions have no database, no application name, no state or no open transaction, as background
    processes and idle connections have.
    """
    pid = F.col("pid")
    pids = F.when(F.col("blocker_pid").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("blocker_pid"))
    stmt = F.concat(F.lit("UPDATE  shop.inventory\n   SET quantity = quantity - 1\n WHERE product_id = "),
                    F.col("blocking_user").cast("string"))
    return samples.select(
        "sample", "pid", F.col("blocking_user").alias("usename"),
        F.when(pid % 3 == 0, "shop").when(pid % 3 == 1, "postgres").alias("datname"),
        F.when(pid % 4 == 0, "").otherwise(F.concat(F.lit("app"), (pid % 2).cast("string"))).alias("application_name"),
        F.lit("client backend").alias("backend_type"),
        F.when(pid % 5 == 1, "idle in transaction").when(pid % 5 != 0, "active").alias("state"),
        F.when(pid % 11 != 0, F.col("xact_start")).alias("xact_start"),
        (F.col("xact_start") + F.make_dt_interval(hours=F.lit(1))).alias("state_change"),
        F.when(F.col("blocker_pid").isNotNull(), F.lit("Lock")).alias("wait_event_type"),
        pids.alias("blocking_pids"), stmt.alias("query"), (F.col("sample") + F.expr("INTERVAL 1 DAY")).alias("clock"))


def application(name: str = "application_name", backend: str = "backend_type") -> Column:
    """The application of a session; a session without a name goes by its backend type."""
    return F.coalesce(F.nullif(F.col(name), F.lit("")), F.col(backend))


def wait_edges(sessions: DataFrame) -> DataFrame:
    """One row per (waiting session, blocker) of sessions waiting on a lock (lateral unnest, J10)."""
    return (sessions.filter(F.col("wait_event_type") == "Lock")
            .select("sample", "pid", F.explode("blocking_pids").alias("blocker_pid")))


def blocking_chains(edges: DataFrame) -> DataFrame:
    """(sample, root_pid, waiting_pid); roots are blockers that wait for nothing; cycle-safe."""
    return transitive_closure(edges, ["sample"], "pid", "blocker_pid")


def _persisting(chains: DataFrame, sessions: DataFrame, min_s: float) -> DataFrame:
    """Chains behind roots whose transaction (or, without one, state) is at least ``min_s`` old."""
    since = F.coalesce("xact_start", "state_change")
    r = sessions.select(
        "sample", F.col("pid").alias("root_pid"), F.coalesce("datname", F.lit("")).alias("datname"), F.col("usename").alias("blocking_user"),
        application().alias("blocking_application"), F.coalesce("state", F.lit("")).alias("blocking_state"), since.alias("since"), "clock",
        F.left(F.regexp_replace("query", r"\s+", " "), F.lit(100)).alias("blocking_query"))
    j = chains.join(r, ["sample", "root_pid"])
    return (j.filter(F.col("since") <= F.col("clock") - F.make_dt_interval(secs=F.lit(min_s)))
            .withColumn("open_s", seconds_between("since", "clock")))


_BLOCKER = ("datname", "blocking_user", "blocking_application", "blocking_state")


def _top(groups: DataFrame, keys: tuple[str, ...], top: int) -> DataFrame:
    """Per sample, the ``top`` groups with most sessions; ties in the order of the keys."""
    w = Window.partitionBy("sample").orderBy(F.col("sessions").desc(), *keys)
    return groups.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= top).drop("rn")


def who_blocks(chains: DataFrame, sessions: DataFrame, min_s: float = 1, top: int = 50) -> DataFrame:
    """Root blockers and the sessions behind them per database, user, application and state; top ``top`` per sample."""
    g = _persisting(chains, sessions, min_s).groupBy("sample", *_BLOCKER).agg(
        F.count_distinct("root_pid").alias("blockers"), F.count_distinct("waiting_pid").alias("sessions"),
        F.round(F.max("open_s"), 3).alias("transaction_seconds"))
    return _top(g, _BLOCKER, top)


def blocking_statements(chains: DataFrame, sessions: DataFrame, min_s: float = 1, top: int = 10) -> DataFrame:
    """The same per statement (whitespace collapsed, first 100 characters); top ``top`` per sample."""
    keys = (*_BLOCKER, "blocking_query")
    g = _persisting(chains, sessions, min_s).groupBy("sample", *keys).agg(
        F.count_distinct("waiting_pid").alias("sessions"), F.round(F.max("open_s"), 3).alias("transaction_seconds"))
    return _top(g, keys, top)


def who_waits(chains: DataFrame, sessions: DataFrame, min_s: float = 1) -> DataFrame:
    """Waiting sessions per sample, database, user and application, and how many are behind a persisting root.

    Totals come from the waiting side (X15): each waiting session is one row, counted once.
    """
    blocked = _persisting(chains, sessions, min_s).select("sample", F.col("waiting_pid").alias("pid")).distinct() \
        .withColumn("_blocked", F.lit(1))
    a = sessions.filter(F.col("wait_event_type") == "Lock")
    return (a.join(blocked, ["sample", "pid"], "left")
            .groupBy("sample", F.coalesce("datname", F.lit("")).alias("datname"), F.col("usename").alias("waiting_user"),
                     application().alias("waiting_application"))
            .agg(F.count(F.lit(1)).alias("sessions"), F.count("_blocked").alias("blocked_sessions")))


# The oracle climbs from every waiting session to the blocker of its blocker, with the way so far in a
# list, and keeps the ends that wait for nobody.
CHAIN_SQL = """WITH RECURSIVE sess AS (
  SELECT sample, pid, blocker_pid, blocking_user, ['shop', 'postgres', ''][1 + pid % 3] AS datname,
         CASE WHEN pid % 4 = 0 THEN 'client backend' ELSE 'app' || CAST(pid % 2 AS VARCHAR) END AS app,
         CASE pid % 5 WHEN 0 THEN '' WHEN 1 THEN 'idle in transaction' ELSE 'active' END AS state,
         epoch(sample + INTERVAL 1 DAY) - epoch(xact_start) - CASE WHEN pid % 11 = 0 THEN 3600 ELSE 0 END AS open_s,
         'UPDATE shop.inventory SET quantity = quantity - 1 WHERE product_id = ' || CAST(blocking_user AS VARCHAR) AS query
  FROM session_samples_v),
up AS (
  SELECT sample, pid AS waiting_pid, blocker_pid AS top, [pid, blocker_pid] AS way FROM sess WHERE blocker_pid IS NOT NULL
  UNION ALL
  SELECT up.sample, waiting_pid, s.blocker_pid, list_append(way, s.blocker_pid)
  FROM up JOIN sess s ON s.sample = up.sample AND s.pid = up.top
  WHERE s.blocker_pid IS NOT NULL AND NOT list_contains(way, s.blocker_pid)),
chain AS (
  SELECT DISTINCT up.sample, top AS root_pid, waiting_pid
  FROM up ANTI JOIN (SELECT sample, pid FROM sess WHERE blocker_pid IS NOT NULL) w ON w.sample = up.sample AND w.pid = up.top),
held AS (SELECT chain.*, datname, blocking_user, app AS blocking_application, state AS blocking_state, open_s, left(query, 100) AS blocking_query
         FROM chain JOIN sess ON sess.sample = chain.sample AND sess.pid = root_pid WHERE open_s >= 1)
"""


def _chains(t: Tables):
    return blocking_chains(wait_edges(sessions_from_samples(t.session_samples_v)))


@register("wait_edges", adapters=("session_samples_v",), oracle="""
SELECT sample, pid, b.blocker_pid FROM session_samples_v s, LATERAL unnest([s.blocker_pid]) AS b(blocker_pid)
WHERE s.blocker_pid IS NOT NULL""")
def q_wait_edges(spark, d):
    return wait_edges(sessions_from_samples(Tables(spark, d).session_samples_v))


@register("blocking_chains", adapters=("session_samples_v",), oracle=CHAIN_SQL + "SELECT sample, root_pid, waiting_pid FROM chain")
def q_blocking_chains(spark, d):
    return _chains(Tables(spark, d))


@register("who_blocks", adapters=("session_samples_v",), oracle=CHAIN_SQL + """
SELECT sample, datname, blocking_user, blocking_application, blocking_state, count(DISTINCT root_pid) AS blockers,
       count(DISTINCT waiting_pid) AS sessions, round(max(open_s), 3) AS transaction_seconds
FROM held GROUP BY 1, 2, 3, 4, 5
QUALIFY row_number() OVER (PARTITION BY sample ORDER BY sessions DESC, datname, blocking_user, blocking_application, blocking_state) <= 50""")
def q_who_blocks(spark, d):
    t = Tables(spark, d)
    return who_blocks(_chains(t), sessions_from_samples(t.session_samples_v))


@register("blocking_statements", adapters=("session_samples_v",), oracle=CHAIN_SQL + """
SELECT sample, datname, blocking_user, blocking_application, blocking_state, blocking_query, count(DISTINCT waiting_pid) AS sessions,
       round(max(open_s), 3) AS transaction_seconds
FROM held GROUP BY 1, 2, 3, 4, 5, 6
QUALIFY row_number() OVER (PARTITION BY sample ORDER BY sessions DESC, datname, blocking_user, blocking_application, blocking_state,
                                                        blocking_query) <= 10""")
def q_blocking_statements(spark, d):
    t = Tables(spark, d)
    return blocking_statements(_chains(t), sessions_from_samples(t.session_samples_v))


@register("who_waits", adapters=("session_samples_v",), oracle=CHAIN_SQL + """
SELECT s.sample, datname, s.blocking_user AS waiting_user, app AS waiting_application, count(*) AS sessions,
       count(*) FILTER (WHERE EXISTS (SELECT 1 FROM held h WHERE h.sample = s.sample AND h.waiting_pid = s.pid)) AS blocked_sessions
FROM sess s WHERE blocker_pid IS NOT NULL GROUP BY ALL""")
def q_who_waits(spark, d):
    t = Tables(spark, d)
    return who_waits(_chains(t), sessions_from_samples(t.session_samples_v))
