"""Live streams with deadlines: match feed (ST02), price verdicts (ST13), expiring sessions (ST07) and
requests that come too late (ST12), each over a feed of several files out of order.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import selection_result, ts_lit
from tillbook.operators.joins import asof_join
from tillbook.operators.windows import segment_bucket, to_periods
from tillbook.plans.registry import register
from tillbook.session import EVENTS_AS_OF
from tillbook.sources.adapters import Tables
from tillbook.streaming.feeds import feed
from tillbook.streaming.ordered import Rows, in_order
from tillbook.streaming.runner import drain_append, event_time, ntz

# ---- ST02 match feed --------------------------------------------------------------------------------

# Full time after kick-off and the suspension of the markets after a goal, in seconds.
FULL_TIME_S = 900
SUSPENDED_S = 15
RETENTION_S = 86_400   # how long a finished match still ignores actions before its state goes
# The selections of a match's three markets, as ``selection_result`` names them.
SELECTIONS = ("home", "draw", "away", "over", "under", "yes", "no")

_STEP = T.StructType([
    T.StructField("match_id", T.LongType()), T.StructField("version", T.LongType()), T.StructField("at_us", T.LongType()),
    T.StructField("event", T.StringType()), T.StructField("status", T.StringType()), T.StructField("market", T.StringType()),
    T.StructField("home_score", T.IntegerType()), T.StructField("away_score", T.IntegerType())])
_MATCH = T.StructType([
    T.StructField("status", T.StringType()), T.StructField("market", T.StringType()), T.StructField("home", T.IntegerType()),
    T.StructField("away", T.IntegerType()), T.StructField("kicked", T.LongType()), T.StructField("reopens", T.LongType()),
    T.StructField("version", T.LongType())])


def _match_fold(match_id, rows: Rows, state: tuple | None, upto: int, full_us: int, suspended_us: int, retention_us: int):
    """One match's actions in order, with its deadlines between them: kick-off opens it; a goal scores and
    suspends its markets; they reopen when the suspension ends; full time closes them. Actions on a match
    that is not live change nothing. A finished match leaves the state after the retention."""
    status, market, home, away, kicked, reopens, version = state or ("scheduled", "open", 0, 0, None, None, 0)
    out = []

    def emit(at: int, event: str) -> None:
        nonlocal version
        version += 1
        out.append((match_id, version, at, event, status, market, home, away))

    for at, action in [*zip(rows["ts_us"].tolist(), rows["action"].tolist(), strict=True), (upto, None)]:
        if status == "live" and reopens is not None and reopens < kicked + full_us and reopens <= at:
            market, due, reopens = "open", reopens, None
            emit(due, "reopen")
        if status == "live" and kicked + full_us <= at:
            status, market, reopens = "finished", "closed", None
            emit(kicked + full_us, "full_time")
        if action == "kickoff" and status == "scheduled":
            status, kicked = "live", at
            emit(at, "kickoff")
        elif action in ("home", "away") and status == "live":
            home, away = home + (action == "home"), away + (action == "away")
            market, reopens = "suspended", at + suspended_us
            emit(at, "goal")
    if status == "scheduled" or (status == "finished" and kicked + full_us + retention_us <= upto):
        return out, None, None
    full = kicked + full_us
    deadline = full + retention_us if status == "finished" else min(full, reopens or full)
    return out, (status, market, home, away, kicked, reopens, version), deadline


def match_feed(actions: DataFrame, full_s: int = FULL_TIME_S, suspended_s: int = SUSPENDED_S, retention_s: int = RETENTION_S) -> DataFrame:
    """ST02: every step of every match, from a stream of actions (match_id, event_id, action, ``_et``).

    Actions are kickoff, home and away (goals). Steps are kickoff, goal (markets suspended), reopen and
    full_time (markets closed), numbered by version; reopen and full time come from event-time timers.
    """
    a = actions.select("match_id", "event_id", "action", "_et", F.unix_micros("_et").alias("ts_us"))
    us = 1_000_000
    fold = partial(_match_fold, full_us=full_s * us, suspended_us=suspended_s * us, retention_us=retention_s * us)
    steps = in_order(a, "match_id", ["event_id"], _STEP, _MATCH, fold)
    return steps.withColumn("happened_at", ntz(F.timestamp_micros("at_us"))).drop("at_us")


def match_results(steps: DataFrame) -> DataFrame:
    """won / lost of every selection of a match at full time."""
    ended = steps.filter(F.col("event") == "full_time").select(
        "match_id", F.col("happened_at").alias("finished_at"), "home_score", "away_score",
        F.explode(F.array(*map(F.lit, SELECTIONS))).alias("selection"))
    return ended.withColumn("result", selection_result("selection", "home_score", "away_score"))


def _match_actions(t: Tables) -> DataFrame:
    """Actions of the fixture's matches: ten neighbouring users play one match a day, in a 24th of its time."""
    day = F.date_trunc("day", event_time("ts"))
    at = F.timestamp_micros(F.unix_micros(day) + ((F.unix_micros(event_time("ts")) - F.unix_micros(day)) / 24).cast("bigint"))
    action = F.when(F.col("event_type") == "signup", "kickoff").when(F.col("event_type") == "purchase", "home").when(
        F.col("event_type") == "click", "away")
    match = F.floor(F.col("user_id") / 10) * 100_000 + F.floor(F.unix_micros(day) / 86_400_000_000)
    return t.events.select(match.cast("bigint").alias("match_id"), "event_id", action.alias("action"), ntz(at).alias("ts")).filter(
        F.col("action").isNotNull())


_STEPS_SQL = f"""WITH a AS (
  SELECT user_id // 10 * 100000 + CAST(epoch_us(date_trunc('day', ts)) // 86400000000 AS BIGINT) AS match_id, event_id,
         make_timestamp(epoch_us(date_trunc('day', ts)) + (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 24) AS ts,
         CASE event_type WHEN 'signup' THEN 'kickoff' WHEN 'purchase' THEN 'home' ELSE 'away' END AS action
  FROM events WHERE event_type IN ('signup', 'purchase', 'click')),
k AS (SELECT match_id, arg_min(event_id, (ts, event_id)) AS kick_id, min(ts) AS kicked FROM a WHERE action = 'kickoff' GROUP BY 1),
g AS (SELECT a.match_id, a.event_id, a.ts, a.action, kicked, lead(a.ts) OVER (PARTITION BY a.match_id ORDER BY a.ts, a.event_id) AS following
      FROM a JOIN k ON k.match_id = a.match_id
      WHERE action <> 'kickoff' AND (a.ts, a.event_id) > (kicked, kick_id) AND a.ts < kicked + INTERVAL {FULL_TIME_S} SECOND),
s AS (SELECT match_id, kicked AS happened_at, 'kickoff' AS event, 2 AS o, kick_id AS tie, 0 AS h, 0 AS a FROM k
      UNION ALL SELECT match_id, ts, 'goal', 2, event_id, CAST(action = 'home' AS INT), CAST(action = 'away' AS INT) FROM g
      UNION ALL SELECT match_id, ts + INTERVAL {SUSPENDED_S} SECOND, 'reopen', 1, 0, 0, 0 FROM g
      WHERE (following IS NULL OR following >= ts + INTERVAL {SUSPENDED_S} SECOND)
        AND ts + INTERVAL {SUSPENDED_S} SECOND < kicked + INTERVAL {FULL_TIME_S} SECOND
      UNION ALL SELECT match_id, kicked + INTERVAL {FULL_TIME_S} SECOND, 'full_time', 3, 0, 0, 0 FROM k),
steps AS (
  SELECT match_id, row_number() OVER w AS version, happened_at, event, CASE event WHEN 'full_time' THEN 'finished' ELSE 'live' END AS status,
         CASE event WHEN 'goal' THEN 'suspended' WHEN 'full_time' THEN 'closed' ELSE 'open' END AS market,
         CAST(sum(h) OVER w AS INT) AS home_score, CAST(sum(a) OVER w AS INT) AS away_score
  FROM s WINDOW w AS (PARTITION BY match_id ORDER BY happened_at, o, tie ROWS UNBOUNDED PRECEDING))
"""


@register("stream_match_feed", oracle=_STEPS_SQL + "SELECT match_id, version, happened_at, event, status, market, home_score, away_score FROM steps")
def q_stream_match_feed(spark, d):
    return drain_append(match_feed(feed(_match_actions(Tables(spark, d)), "match-actions", "ts", "event_id")), "match-feed")


@register("stream_match_results", oracle=_STEPS_SQL + """
SELECT match_id, happened_at AS finished_at, home_score, away_score, selection,
       CASE WHEN CASE selection WHEN 'home' THEN home_score > away_score WHEN 'draw' THEN home_score = away_score
                 WHEN 'away' THEN home_score < away_score WHEN 'over' THEN home_score + away_score >= 3
                 WHEN 'under' THEN home_score + away_score <= 2 WHEN 'yes' THEN least(home_score, away_score) >= 1
                 ELSE least(home_score, away_score) = 0 END THEN 'won' ELSE 'lost' END AS result
FROM steps, (SELECT unnest(['home', 'draw', 'away', 'over', 'under', 'yes', 'no']) AS selection) WHERE event = 'full_time'""")
def q_stream_match_results(spark, d):
    return match_results(q_stream_match_feed(spark, d))


# ---- ST13 price check ---------------------------------------------------------------------------------

LOOKBACK = "1 day"       # the feed repeats every price in force at midnight, so none is older
TOLERANCE = 0.02         # a bet at a price further off than this has to be confirmed


def republished(odds: DataFrame, until) -> DataFrame:
    """Price moves (selection_id, odds, changed_at, id) with published_at: when they were made, and every
    midnight at which they were in force, up to ``until`` (a timestamp column without references)."""
    p = to_periods(odds.withColumn("_at", F.unix_micros(event_time("changed_at"))), ["selection_id"], "_at", ["changed_at", "id"],
                   segment_bucket("changed_at"))
    first = F.date_trunc("day", event_time("changed_at")) + F.make_dt_interval(days=F.lit(1))
    last = F.coalesce(F.timestamp_micros("valid_to"), until)
    nights = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).otherwise(F.array().cast("array<timestamp>"))
    at = F.explode(F.concat(F.array(event_time("changed_at")), nights))
    return p.select("selection_id", "odds", "changed_at", "id", at.alias("published_at")).withColumn("published_at", ntz(F.col("published_at")))


def price_checks(bets: DataFrame, prices: DataFrame, lookback: str = LOOKBACK, tolerance: float = TOLERANCE) -> DataFrame:
    """ST13: the price in force for every bet and whether the player saw it, as a join of two streams.

    ``bets`` (bet_id, selection_id, placed_at, seen) and ``prices`` (selection_id, odds, changed_at, id)
    have event times ``_et``. Prices published within ``lookback`` before a bet meet it in an interval
    join, whose state leaves with the watermark; the latest change of them is chosen by an aggregation
    that closes with the watermark as well. A bet without a price is given out with none.
    """
    b = bets.withColumnRenamed("_et", "_placed")
    p = prices.select(F.col("selection_id").alias("_selection"), "odds", "changed_at", "id", F.col("_et").alias("_published"))
    met = b.join(p, F.expr(f"selection_id = _selection AND _published <= _placed AND _published >= _placed - INTERVAL {lookback}"), "leftOuter")
    best = met.groupBy("bet_id", "selection_id", "placed_at", "seen", "_placed").agg(
        F.max_by("odds", F.when(F.col("id").isNotNull(), F.struct("changed_at", "id"))).alias("odds"))
    off = F.abs(F.col("odds") - F.col("seen")) > F.col("seen") * F.lit(tolerance).cast("decimal(3,2)")
    verdict = F.when(F.col("odds").isNull(), "market_suspended").when(F.col("seen").isNull() | off, "odds_changed").otherwise("ok")
    return best.select("bet_id", "selection_id", "placed_at", "seen", "odds", verdict.alias("verdict"))


def _price_checks(spark, d) -> DataFrame:
    """The fixture's bets, each at the price of its selection some hours before, against the odds feed."""
    t = Tables(spark, d)
    bets = t.events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("bet_id"), F.col("user_id").alias("selection_id"), F.col("ts").alias("placed_at"),
        (F.col("ts") - F.make_dt_interval(hours=(F.col("event_id") % 6 * 10).cast("int"))).alias("looked_at"))
    bets = asof_join(bets, t.odds_feed_v, ["selection_id"], "looked_at", "changed_at", ["odds"], right_order=["id"])
    bets = feed(bets.select("bet_id", "selection_id", "placed_at", F.col("odds").alias("seen")), "bets", "placed_at", "bet_id")
    prices = feed(republished(t.odds_feed_v, ts_lit(EVENTS_AS_OF).cast("timestamp")), "prices", "published_at", "id")
    return drain_append(price_checks(bets, prices), "price-checks")


_PRICE_SQL = """WITH b AS (
  SELECT event_id AS bet_id, user_id AS selection_id, ts AS placed_at, ts - to_hours(CAST(event_id % 6 * 10 AS BIGINT)) AS looked_at
  FROM events WHERE event_type = 'purchase'),
p AS (SELECT b.bet_id, max_by(f.odds, (f.changed_at, f.id)) AS odds,
             max_by(f.odds, (f.changed_at, f.id)) FILTER (WHERE f.changed_at <= b.looked_at) AS seen
      FROM b JOIN odds_feed_v f ON f.selection_id = b.selection_id AND f.changed_at <= b.placed_at GROUP BY 1)
"""


@register("stream_price_check", adapters=("odds_feed_v",), oracle=_PRICE_SQL + """
SELECT b.bet_id, selection_id, placed_at, odds FROM b LEFT JOIN p ON p.bet_id = b.bet_id""")
def q_stream_price_check(spark, d):
    """ST13: the price in force when each bet arrived."""
    return _price_checks(spark, d).select("bet_id", "selection_id", "placed_at", "odds")


@register("stream_price_verdicts", adapters=("odds_feed_v",), oracle=_PRICE_SQL + """
SELECT b.bet_id, selection_id, placed_at, seen, odds,
       CASE WHEN odds IS NULL THEN 'market_suspended' WHEN seen IS NULL OR abs(odds - seen) > seen * 0.02 THEN 'odds_changed' ELSE 'ok' END
       AS verdict
FROM b LEFT JOIN p ON p.bet_id = b.bet_id""")
def q_stream_price_verdicts(spark, d):
    """ST13: and whether it was within 2% of the price that the player saw."""
    return _price_checks(spark, d)


# ---- ST07 sessions ------------------------------------------------------------------------------------------

SESSION_HOURS = 2

_SESSION = T.StructType([T.StructField("player_id", T.LongType()), T.StructField("request_id", T.LongType()),
                         T.StructField("created_us", T.LongType()), T.StructField("ts_us", T.LongType())])


def _expire(player_id, rows: Rows, state: tuple | None, _upto: int):
    return list(zip([player_id] * len(rows), rows["request_id"].tolist(), rows["created_us"].tolist(), rows["ts_us"].tolist(),
                    strict=True)), None, None


def session_activity(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Gap-based player sessions in append mode (event time ``_et``): a session is given out once the
    watermark has passed its end, and leaves the state. start, end (= last event + gap), events."""
    return (events.groupBy(F.session_window("_et", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("events"))
            .select("user_id", ntz(F.col("s.start")).alias("session_start"), ntz(F.col("s.end")).alias("session_end"), "events"))


def session_expiry(logins: DataFrame, hours: int = SESSION_HOURS) -> DataFrame:
    """ST07: a session per login (request_id, player_id, event time ``_et``) lives ``hours`` in the player's state;
    when the watermark passes its expiry it is given out and leaves. What is still live is only in state."""
    created = F.unix_micros("_et")
    rows = logins.select("player_id", "request_id", created.alias("created_us"), (created + hours * 3_600_000_000).alias("ts_us"), "_et")
    no_state = T.StructType([T.StructField("unused", T.BooleanType())])
    out = in_order(rows, "player_id", ["request_id"], _SESSION, no_state, _expire)
    return out.select(F.md5(F.col("request_id").cast("string")).alias("token"), "player_id",
                      ntz(F.timestamp_micros("created_us")).alias("created_at"), ntz(F.timestamp_micros("ts_us")).alias("expired_at"))


@register("stream_sessions", oracle="""
WITH l AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM l)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events
FROM s GROUP BY user_id, sid""")
def q_stream_sessions(spark, d):
    ev = feed(Tables(spark, d).events.select("user_id", "event_id", "ts"), "activity", "ts", "event_id")
    return drain_append(session_activity(ev), "sessions")


@register("stream_session_expiry", adapters=("players_v",), oracle=f"""
SELECT md5(CAST(e.event_id AS VARCHAR)) AS token, e.user_id AS player_id, e.ts AS created_at, e.ts + INTERVAL 2 HOUR AS expired_at
FROM events e JOIN players_v p ON p.id = e.user_id AND p.status = 'active'
WHERE e.event_type = 'click' AND e.ts + INTERVAL 2 HOUR <= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 2 DAY""")
def q_stream_session_expiry(spark, d):
    """ST07: the sessions that have run out two days before the end of the feed; those that have not are live_sessions'
    kind (M11) and stay in state."""
    t = Tables(spark, d)
    until = "2024-01-29 00:00:00"
    logins = t.events.filter((F.col("event_type") == "click") & (F.col("ts") <= ts_lit(until)))
    active = t.players_v.filter(F.col("status") == "active").select(F.col("id").alias("user_id"))
    logins = logins.join(active, "user_id", "left_semi").select(F.col("event_id").alias("request_id"), F.col("user_id").alias("player_id"), "ts")
    return drain_append(session_expiry(feed(logins, "logins", "ts", "request_id", complete_to=until)), "session-expiry")


# ---- ST12 requests that come too late ------------------------------------------------------------------------

def split_expired(requests: DataFrame, seconds: int = 30) -> DataFrame:
    """ST12: ``expired`` for requests processed more than ``seconds`` after they arrived; they are never applied."""
    age = F.unix_micros(event_time("processed_at")) - F.unix_micros(event_time("ts"))
    return requests.withColumn("expired", age > seconds * 1_000_000)


@register("stream_split_requests", adapters=("requests_v",), oracle="""
SELECT tx, event_id % 60 > 30 AS expired, count(*) AS requests, min(ts) AS first_at, max(ts) AS last_at,
       CAST(sum(CASE WHEN event_id % 60 > 30 THEN 0 ELSE latency_ms END) AS DECIMAL(22,2)) AS applied_ms
FROM requests_v GROUP BY 1, 2""")
def q_stream_split_requests(spark, d):
    """ST12: both outputs, written side by side; only live requests are applied."""
    r = Tables(spark, d).requests_v.withColumn(
        "processed_at", F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 60).cast("decimal(8,6)")))
    both = drain_append(split_expired(feed(r, "requests", "ts", "event_id")).drop("_et"), "split-requests")
    applied = F.when(F.col("expired"), F.lit(0)).otherwise(F.col("latency_ms"))
    return both.groupBy("tx", "expired").agg(F.count(F.lit(1)).alias("requests"), F.min("ts").alias("first_at"), F.max("ts").alias("last_at"),
                                             F.sum(applied).cast("decimal(22,2)").alias("applied_ms"))
