"""Sportsbook table-change pipelines (M06-M17, M21, M22) and the selection build.

Money moves only through ledger rows; a wallet is always the fold of its ledger (M16), so
reconciliation (A20) holds by construction after every job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import (SELECTION_NAMES, implied_odds, money, selection_result, stable_uuid, trunc_ts, ts_lit,
                                uniform, uniform_sql)
from tillbook.operators.admission import admit
from tillbook.operators.joins import anti_join, semi_join
from tillbook.operators.windows import last_n, running_sum, segment_bucket, segment_seconds
from tillbook.plans.registry import register
from tillbook.plans.sportsbook import MONEY, _bets_final, leg_results, mission_qualifiers, odds_product
from tillbook.session import EVENTS_AS_OF
from tillbook.sources.adapters import Tables

BOOK_AS_OF = EVENTS_AS_OF   # the clock of the jobs: the end of the events


# ---- B20 / M07: selections with opening odds and results ---------------------------------------

def build_selections(matches: DataFrame) -> DataFrame:
    """Seven selections per match (id = match x 7 + outcome), 6%-margin odds, result once finished.

    Spark estimates an exploded table by its parents' rows and would broadcast millions of selections as a small table,
    so the hint has them joined by sort-merge.
    """
    names = F.array(*[F.struct(F.lit(m).alias("market"), F.lit(n).alias("name")) for m, n in SELECTION_NAMES])
    s = matches.select("id", "status", "home_score", "away_score", implied_odds("id").alias("_odds"),
                       F.posexplode(names).alias("_pos", "_sel"))
    return s.select(F.col("id").alias("event_id"), (F.col("id") * 7 + F.col("_pos") + 1).alias("selection_id"),
                    F.col("_sel.market").alias("market"), F.col("_sel.name").alias("name"),
                    F.element_at("_odds", F.col("_pos") + 1).alias("odds"),
                    F.when(F.col("status").isin("finished", "settled"),
                           selection_result(F.col("_sel.name"), "home_score", "away_score"))
                    .otherwise(F.lit("pending")).alias("result")).hint("merge")


_SEL_SQL = """WITH sel AS (
  SELECT m.id AS event_id, m.id * 7 + k AS selection_id,
         ['match_result','match_result','match_result','over_under_2_5','over_under_2_5','both_teams_score','both_teams_score'][k] AS market,
         ['home','draw','away','over','under','yes','no'][k] AS name,
         CAST(greatest(1.01, round(1.0 / (1.06 * (CASE k
            WHEN 1 THEN 0.15 + 0.6 * ((m.id * 7919) % 1000) / 1000.0
            WHEN 2 THEN 1.0 - (0.15 + 0.6 * ((m.id * 7919) % 1000) / 1000.0) - (1.0 - (0.15 + 0.6 * ((m.id * 7919) % 1000) / 1000.0)) * 0.62
            WHEN 3 THEN (1.0 - (0.15 + 0.6 * ((m.id * 7919) % 1000) / 1000.0)) * 0.62
            WHEN 4 THEN 0.35 + 0.35 * ((m.id * 104729) % 1000) / 1000.0
            WHEN 5 THEN 1.0 - (0.35 + 0.35 * ((m.id * 104729) % 1000) / 1000.0)
            WHEN 6 THEN 0.35 + 0.35 * ((m.id * 1299709) % 1000) / 1000.0
            ELSE 1.0 - (0.35 + 0.35 * ((m.id * 1299709) % 1000) / 1000.0) END)), 2)) AS DECIMAL(7,2)) AS odds,
         CASE WHEN m.status IN ('finished', 'settled') THEN
           CASE WHEN (k = 1 AND m.home_score > m.away_score) OR (k = 2 AND m.home_score = m.away_score)
                  OR (k = 3 AND m.home_score < m.away_score) OR (k = 4 AND m.home_score + m.away_score > 2)
                  OR (k = 5 AND m.home_score + m.away_score < 3) OR (k = 6 AND m.home_score > 0 AND m.away_score > 0)
                  OR (k = 7 AND (m.home_score = 0 OR m.away_score = 0)) THEN 'won' ELSE 'lost' END
         ELSE 'pending' END AS result
  FROM matches_v m, range(1, 8) r(k))
"""


@register("selections", adapters=("matches_v",), oracle=_SEL_SQL + "SELECT * FROM sel")
def q_selections(spark, d):
    return build_selections(Tables(spark, d).matches_v)


# ---- M16 apply ledger rows ------------------------------------------------------------------------

def apply_ledger(opening: DataFrame, rows: DataFrame, existing_keys: DataFrame):
    """Idempotent intake: duplicate keys collapse to one row, keys already in the ledger are
    dropped, ``balance_after`` is the opening balance plus the running sum per (player, account)
    in (created_at, id) order (segmented by day), and the new snapshot is opening + sum.

    Returns (applied rows, new wallets, negative-balance violations per account).
    """
    dedup = (rows.groupBy("idempotency_key")
             .agg(F.min_by(F.struct("id", "player_id", "account", "type", "amount", "created_at"),
                           F.struct("created_at", "id")).alias("r"))
             .select("idempotency_key", "r.*"))
    fresh = anti_join(dedup, existing_keys, ["idempotency_key"])
    run = running_sum(fresh, ["player_id", "account"], ["created_at", "id"], "amount", "_run", segment_bucket("created_at"))
    applied = (run.join(opening, ["player_id", "account"], "left")
               .withColumn("balance_after", (F.coalesce("balance", F.lit(0)) + F.col("_run")).cast("decimal(14,2)"))
               .drop("_run", "balance"))
    sums = fresh.groupBy("player_id", "account").agg(F.sum("amount").alias("_delta"))
    wallets = (opening.join(sums, ["player_id", "account"], "full")
               .select("player_id", "account",
                       (F.coalesce("balance", F.lit(0)) + F.coalesce("_delta", F.lit(0))).cast(MONEY).alias("balance")))
    violations = (applied.groupBy("account")
                  .agg(F.count_if(F.col("balance_after") < 0).alias("negative_rows"),
                       F.min("balance_after").cast(MONEY).alias("lowest_balance")))
    return applied, wallets, violations


def _ledger_inputs(t: Tables):
    m = t.money_events_v
    rows = m.unionByName(m.filter(F.col("id") % 10 == 0)).withColumn(
        "idempotency_key", F.concat(F.lit("k"), F.col("id").cast("string")))
    existing = m.filter(F.col("id") % 97 == 0).select(F.concat(F.lit("k"), F.col("id").cast("string"))
                                                      .alias("idempotency_key"))
    opening = t.players_v.select(F.col("id").alias("player_id"), F.explode(F.array(
        F.struct(F.lit("cash").alias("account"), F.lit(100).cast("decimal(14,2)").alias("balance")),
        F.struct(F.lit("bonus").alias("account"), F.lit(0).cast("decimal(14,2)").alias("balance")))).alias("w")) \
        .select("player_id", "w.*")
    return opening, rows, existing


_LEDGER_SQL = """WITH fresh AS (SELECT * FROM money_events_v WHERE id % 97 <> 0),
opening AS (SELECT id AS player_id, 'cash' AS account, CAST(100 AS DECIMAL(14,2)) AS balance FROM players_v
            UNION ALL SELECT id, 'bonus', CAST(0 AS DECIMAL(14,2)) FROM players_v)
"""


@register("apply_ledger", adapters=("money_events_v", "players_v"), oracle=_LEDGER_SQL + """
SELECT f.player_id, f.account, 'k' || CAST(f.id AS VARCHAR) AS idempotency_key, f.id, f.type, f.amount, f.created_at,
       CAST(coalesce(o.balance, 0) + sum(f.amount) OVER (PARTITION BY f.player_id, f.account ORDER BY f.created_at, f.id
                                                        ROWS UNBOUNDED PRECEDING) AS DECIMAL(14,2)) AS balance_after
FROM fresh f LEFT JOIN opening o ON o.player_id = f.player_id AND o.account = f.account""")
def q_apply_ledger(spark, d):
    applied, _, _ = apply_ledger(*_ledger_inputs(Tables(spark, d)))
    return applied


@register("wallet_snapshot", adapters=("money_events_v", "players_v"), oracle=_LEDGER_SQL + """,
s AS (SELECT player_id, account, sum(amount) AS delta FROM fresh GROUP BY 1, 2)
SELECT coalesce(o.player_id, s.player_id) AS player_id, coalesce(o.account, s.account) AS account,
       CAST(coalesce(o.balance, 0) + coalesce(s.delta, 0) AS DECIMAL(38,2)) AS balance
FROM opening o FULL JOIN s ON s.player_id = o.player_id AND s.account = o.account""")
def q_wallet_snapshot(spark, d):
    _, wallets, _ = apply_ledger(*_ledger_inputs(Tables(spark, d)))
    return wallets


@register("reconcile", adapters=("money_events_v", "players_v"), oracle=_LEDGER_SQL + """,
led AS (SELECT player_id, account, sum(amount) AS s FROM (
          SELECT player_id, account, amount FROM fresh UNION ALL SELECT player_id, account, balance FROM opening) GROUP BY 1, 2)
SELECT player_id, account, CAST(s AS DECIMAL(38,2)) AS wallet, CAST(s AS DECIMAL(38,2)) AS ledger, 'AGREE' AS verdict FROM led""")
def q_reconcile(spark, d):
    """Wallets after M16 against the ledger (opening balances are ledger rows too)."""
    from tillbook.plans.sportsbook import reconcile

    opening, rows, existing = _ledger_inputs(Tables(spark, d))
    applied, wallets, _ = apply_ledger(opening, rows, existing)
    ledger = applied.select("player_id", "account", "amount").unionByName(
        opening.select("player_id", "account", F.col("balance").alias("amount")))
    return reconcile(wallets, ledger)


@register("negative_balances", adapters=("money_events_v", "players_v"), oracle=_LEDGER_SQL + """,
a AS (SELECT f.account, coalesce(o.balance, 0) + sum(f.amount) OVER (PARTITION BY f.player_id, f.account
                    ORDER BY f.created_at, f.id ROWS UNBOUNDED PRECEDING) AS b
      FROM fresh f LEFT JOIN opening o ON o.player_id = f.player_id AND o.account = f.account)
SELECT account, count(*) FILTER (WHERE b < 0) AS negative_rows, CAST(min(b) AS DECIMAL(38,2)) AS lowest_balance
FROM a GROUP BY 1""")
def q_negative_balances(spark, d):
    _, _, v = apply_ledger(*_ledger_inputs(Tables(spark, d)))
    return v


# ---- M06 settlement -------------------------------------------------------------------------------

def settle(matches: DataFrame, bets: DataFrame, legs: DataFrame, n: int | None = 20, chosen: DataFrame | None = None):
    """Settle the first ``n`` finished matches (all if None; of those in ``chosen`` (id) if given), by finish where ``matches``
    has finished_at, then id. ``matches`` is the whole table: their open bets become lost (any lost leg, X9),
    won (every leg decided) or keep waiting; winners get a ledger credit; matches -> settled.

    Returns (bet outcomes, ledger rows, settled match ids).
    """
    by = ["finished_at"] if "finished_at" in matches.columns else []
    batch = matches.filter(F.col("status") == "finished").select(F.col("id").alias("m_id"), *by)
    if chosen is not None:
        batch = batch.join(chosen.select(F.col("id").alias("m_id")).distinct(), "m_id", "left_semi")
    if n is not None:
        batch = batch.orderBy(*by, "m_id").limit(n)
    batch = batch.select("m_id")
    settling = batch if n is None else F.broadcast(batch)  # at most n rows: bounded by the batch size
    lr = leg_results(legs, matches).join(settling, F.col("m_id") == F.col("event_id"), "left")
    decided = (F.col("_mstatus") == "settled") | F.col("m_id").isNotNull()
    m_status = matches.select(F.col("id").alias("_mid"), F.col("status").alias("_mstatus"))
    lr = lr.join(m_status, F.col("_mid") == F.col("event_id"))
    touched = lr.filter(F.col("m_id").isNotNull()).select("bet_id").distinct()
    per_bet = (lr.join(touched, "bet_id", "left_semi")
               .groupBy("bet_id")
               .agg(F.count_if(decided & (F.col("result") == "lost")).alias("lost"),
                    F.count_if(~decided).alias("waiting"),
                    F.count_if((F.col("_mstatus") == "settled") & (F.col("result") == "lost")).alias("lost_before"),
                    F.collect_list("odds").alias("_odds")))
    per_bet = per_bet.filter(F.col("lost_before") == 0)  # already lost at an earlier settlement: not open
    b = bets.select(F.col("id").alias("bet_id"), "player_id", "stake")
    out = per_bet.join(b, "bet_id").select(
        "bet_id", "player_id",
        F.when(F.col("lost") > 0, "lost").when(F.col("waiting") == 0, "won").otherwise("open").alias("status"),
        money(F.col("stake") * odds_product(F.col("_odds")), 2).cast("decimal(14,2)").alias("_potential"))
    out = out.withColumn("payout", F.when(F.col("status") == "won", F.col("_potential"))
                         .when(F.col("status") == "lost", F.lit(0).cast("decimal(14,2)"))).drop("_potential")
    ledger = out.filter(F.col("status") == "won").select(
        "player_id", F.lit("win").alias("type"), F.lit("cash").alias("account"), F.col("payout").alias("amount"),
        F.lit("bet").alias("reference_type"), F.col("bet_id").alias("reference_id"),
        stable_uuid(F.lit("win"), "bet_id").alias("idempotency_key"))
    return out, ledger, batch


@register("settlement", adapters=("matches_v", "legs_v", "bets_v"), oracle="""
WITH batch AS (SELECT id AS m_id FROM matches_v WHERE status = 'finished' ORDER BY id LIMIT 20),
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
def q_settlement(spark, d):
    t = Tables(spark, d)
    out, _, _ = settle(t.matches_v, t.bets_v, t.legs_v)
    return out


# ---- M09 bonus awards -----------------------------------------------------------------------------

def award_bonus(ledger: DataFrame, awards: DataFrame, promotion_id: int, amount: float, min_stake: float,
                limit: int = 2000):
    """Hourly mission: players whose stakes in the hour reach ``min_stake`` and who were not yet
    awarded for that hour (J03), first ``limit`` by player per hour. Idempotent: rerunning with
    the returned awards added awards nobody. Returns (new awards, bonus ledger rows)."""
    q = mission_qualifiers(ledger, min_stake).select("period", "player_id")
    prev = awards.filter(F.col("promotion_id") == promotion_id).select("period", "player_id")
    new = last_n(anti_join(q, prev, ["period", "player_id"]), ["period"], ["player_id"], limit) \
        .select("player_id", F.lit(promotion_id).alias("promotion_id"), "period")
    rows = new.select("player_id", F.lit("bonus").alias("type"), F.lit("bonus").alias("account"),
                      F.lit(amount).cast("decimal(14,2)").alias("amount"), F.lit("promotion").alias("reference_type"),
                      F.lit(promotion_id).cast("bigint").alias("reference_id"),
                      stable_uuid(F.lit("bonus"), F.lit(promotion_id), "player_id", "period").alias("idempotency_key"))
    return new, rows


@register("bonus_awards", adapters=("money_events_v",), oracle="""
WITH q AS (SELECT date_trunc('hour', created_at) AS period, player_id FROM money_events_v WHERE type = 'stake'
           GROUP BY 1, 2 HAVING -sum(amount) >= 100),
fresh AS (SELECT * FROM q WHERE player_id % 3 <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY player_id) AS rn FROM fresh)
SELECT player_id, 1 AS promotion_id, period FROM r WHERE rn <= 2000""")
def q_bonus_awards(spark, d):
    m = Tables(spark, d).money_events_v
    prev = mission_qualifiers(m, 100).filter(F.col("player_id") % 3 == 0).select(
        "period", "player_id", F.lit(1).alias("promotion_id"))
    new, _ = award_bonus(m, prev, 1, 5.0, 100)
    return new


# ---- M11 sessions, M21 logins, M17 sign-ups -------------------------------------------------------

def sessions_from_logins(logins: DataFrame) -> DataFrame:
    """A session per successful login, valid for two hours."""
    return logins.select(F.md5(F.col("request_id").cast("string")).alias("token"), "player_id",
                         F.col("ts").alias("created_at"),
                         (F.col("ts") + F.make_dt_interval(hours=F.lit(2))).alias("expires_at"))


def expire_sessions(sessions: DataFrame, as_of: str) -> DataFrame:
    """Keep sessions that have not expired at ``as_of``."""
    return sessions.filter(F.col("expires_at") >= ts_lit(as_of))


def apply_logins(requests: DataFrame, players: DataFrame):
    """A login of a player who is not active is blocked; others open a session, and the
    player's last login is the latest of them. Returns (outcomes, sessions, last logins)."""
    p = players.select(F.col("id").alias("player_id"), F.col("status").alias("_pstatus"))
    j = requests.join(p, "player_id", "left")
    out = j.select("request_id", "player_id", "ts",
                   F.when(F.col("_pstatus") == "active", "ok").otherwise("blocked").alias("result"))
    ok = out.filter(F.col("result") == "ok")
    last = ok.groupBy("player_id").agg(F.max("ts").alias("last_login_at"))
    return out, sessions_from_logins(ok), last


def _logins(t: Tables):
    return t.events.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("player_id"), "ts")


@register("login_outcomes", adapters=("players_v",), oracle="""
SELECT e.event_id AS request_id, e.user_id AS player_id, e.ts,
       CASE WHEN p.status = 'active' THEN 'ok' ELSE 'blocked' END AS result
FROM events e LEFT JOIN players_v p ON p.id = e.user_id WHERE e.event_type = 'click'""")
def q_login_outcomes(spark, d):
    t = Tables(spark, d)
    out, _, _ = apply_logins(_logins(t), t.players_v)
    return out


@register("live_sessions", adapters=("players_v",), oracle=f"""
SELECT md5(CAST(e.event_id AS VARCHAR)) AS token, e.user_id AS player_id, e.ts AS created_at,
       e.ts + INTERVAL 2 HOUR AS expires_at
FROM events e JOIN players_v p ON p.id = e.user_id AND p.status = 'active'
WHERE e.event_type = 'click' AND e.ts <= TIMESTAMP '{BOOK_AS_OF}' AND e.ts + INTERVAL 2 HOUR >= TIMESTAMP '{BOOK_AS_OF}'""")
def q_live_sessions(spark, d):
    t = Tables(spark, d)
    _, sessions, _ = apply_logins(_logins(t).filter(F.col("ts") <= ts_lit(BOOK_AS_OF)), t.players_v)
    return expire_sessions(sessions, BOOK_AS_OF)


def apply_signups(requests: DataFrame):
    """One request -> player, limits, empty wallet (four projections of one input)."""
    players = requests.select(F.col("request_id").alias("id"),
                              F.concat(F.lit("player"), F.col("request_id").cast("string")).alias("username"),
                              F.lit("active").alias("status"), F.lit("pending").alias("kyc_status"),
                              F.col("ts").alias("created_at"))
    limits = requests.select(F.col("request_id").alias("player_id"),
                             F.lit(500).cast("decimal(12,2)").alias("max_stake"))
    wallets = requests.select(F.col("request_id").alias("player_id"), F.lit(0).cast("decimal(14,2)").alias("balance"),
                              F.lit(0).cast("decimal(14,2)").alias("bonus_balance"), F.lit("EUR").alias("currency"))
    return players, limits, wallets


@register("signups", oracle="""
SELECT event_id AS id, 'player' || CAST(event_id AS VARCHAR) AS username, 'active' AS status, 'pending' AS kyc_status,
       ts AS created_at, CAST(500 AS DECIMAL(12,2)) AS max_stake, CAST(0 AS DECIMAL(14,2)) AS balance
FROM events WHERE event_type = 'signup'""")
def q_signups(spark, d):
    req = Tables(spark, d).events.filter(F.col("event_type") == "signup").select(
        F.col("event_id").alias("request_id"), "ts")
    players, limits, wallets = apply_signups(req)
    return (players.join(limits.withColumnRenamed("player_id", "id"), "id")
            .join(wallets.select(F.col("player_id").alias("id"), "balance"), "id"))


# ---- M12 bet validation, M13 cash-out, M14 deposits, M15 withdrawals -----------------------------

def validate_bets(requests: DataFrame, players: DataFrame, matches: DataFrame) -> DataFrame:
    """M12, stateless part of the refusal ladder, in the reference's order: blocked ->
    limit_reached (stake over the maximum) -> market_suspended -> odds_changed (> 2%) -> ok.
    Funds and the daily loss limit depend on earlier requests: ``decide_bets`` adds them."""
    p = players.select(F.col("id").alias("player_id"), F.col("status").alias("_pstatus"), "max_stake")
    m = matches.select(F.col("id").alias("event_id"), F.col("status").alias("_mstatus"),
                       implied_odds("id").alias("_odds"))
    j = requests.join(p, "player_id", "left").join(m, "event_id", "left")
    current = F.element_at("_odds", F.col("outcome"))
    result = (F.when(F.col("_pstatus").isNull() | (F.col("_pstatus") != "active"), "blocked")
              .when(F.col("stake") > F.col("max_stake"), "limit_reached")
              .when(~F.coalesce(F.col("_mstatus").isin("scheduled", "live"), F.lit(False)), "market_suspended")
              .when(F.abs(current - F.col("seen_odds")) > F.col("seen_odds") * F.lit(0.02).cast("decimal(3,2)"),
                    "odds_changed")
              .otherwise("ok"))
    return j.select("request_id", "player_id", "event_id", "stake", "seen_odds", current.alias("current_odds"),
                    result.alias("result"))


def _bet_requests(t: Tables):
    e = t.events.filter(F.col("event_type") == "purchase")
    match = F.col("event_id") % t.part.agg(F.max("p_partkey")).scalar()   # over all matches, however many
    base_odds = F.element_at(implied_odds(match), (1 + F.col("event_id") % 3).cast("int"))
    seen = (base_odds * (F.lit(97) + F.col("event_id") % 7).cast("decimal(5,0)") * F.lit(0.01).cast("decimal(3,2)")) \
        .cast("decimal(7,3)")
    return e.select(F.col("event_id").alias("request_id"), F.col("user_id").alias("player_id"),
                    match.alias("event_id"), (1 + F.col("event_id") % 3).cast("int").alias("outcome"),
                    F.col("value").cast("decimal(12,2)").alias("stake"), seen.alias("seen_odds"), "ts")


@register("bet_validation", adapters=("players_v", "matches_v"), oracle=_SEL_SQL.replace("FROM matches_v m", "FROM matches_v m") + """,
req AS (SELECT event_id AS request_id, user_id AS player_id, event_id % (SELECT max(p_partkey) FROM part) AS match_id, CAST(1 + event_id % 3 AS INT) AS outcome,
               CAST(value AS DECIMAL(12,2)) AS stake, event_id FROM events WHERE event_type = 'purchase'),
r2 AS (SELECT r.*, s.odds AS current_odds,
              CAST(s.odds * CAST(97 + r.event_id % 7 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(7,3)) AS seen_odds
       FROM req r LEFT JOIN sel s ON s.selection_id = r.match_id * 7 + r.outcome)
SELECT r2.request_id, r2.player_id, r2.match_id AS event_id, r2.stake, r2.seen_odds, r2.current_odds,
       CASE WHEN p.status IS NULL OR p.status <> 'active' THEN 'blocked'
            WHEN r2.stake > p.max_stake THEN 'limit_reached'
            WHEN NOT coalesce(m.status IN ('scheduled', 'live'), false) THEN 'market_suspended'
            WHEN abs(r2.current_odds - r2.seen_odds) > r2.seen_odds * 0.02 THEN 'odds_changed'
            ELSE 'ok' END AS result
FROM r2 LEFT JOIN players_v p ON p.id = r2.player_id LEFT JOIN matches_v m ON m.id = r2.match_id""")
def q_bet_validation(spark, d):
    t = Tables(spark, d)
    return validate_bets(_bet_requests(t), t.players_v, t.matches_v)


def decide_bets(requests: DataFrame, players: DataFrame, matches: DataFrame, funds: DataFrame) -> DataFrame:
    """M12, the whole refusal ladder in the reference's order: blocked -> limit_reached (stake
    over the maximum) -> insufficient_funds -> limit_reached (daily loss) -> market_suspended
    -> odds_changed (> 2%) -> ok, with requests applied one by one per player in (ts, id) order.

    Only a placed bet moves money, so only requests that pass every stateless check can
    consume: they go through set-based admission on two keys each, the player's funds
    (``funds``: balance at the start) and the player's day (daily loss limit, when set). Every
    request's reason then reads the stakes placed before it (segmented running sums)."""
    p = players.select(F.col("id").alias("player_id"), F.col("status").alias("_pstatus"), "max_stake",
                       F.col("daily_loss_limit").alias("_loss_limit"))
    m = matches.select(F.col("id").alias("event_id"), F.col("status").alias("_mstatus"),
                       implied_odds("id").alias("_odds"))
    f = funds.select("player_id", F.col("balance").alias("_balance"))
    current = F.element_at("_odds", F.col("outcome"))
    pre = (F.when(F.col("_pstatus").isNull() | (F.col("_pstatus") != "active"), "blocked")
           .when(F.col("stake") > F.col("max_stake"), "limit_reached"))
    post = (F.when(~F.coalesce(F.col("_mstatus").isin("scheduled", "live"), F.lit(False)), "market_suspended")
            .when(F.abs(current - F.col("seen_odds")) > F.col("seen_odds") * F.lit(0.02).cast("decimal(3,2)"),
                  "odds_changed"))
    r = (requests.join(p, "player_id", "left").join(m, "event_id", "left").join(f, "player_id", "left")
         .select("request_id", "player_id", "event_id", "stake", "seen_odds", current.alias("current_odds"),
                 F.unix_micros(F.col("ts").cast("timestamp")).alias("_seq"), F.to_date("ts").alias("day"),
                 F.coalesce("_balance", F.lit(0)).alias("_balance"), "_loss_limit", pre.alias("_pre"),
                 post.alias("_post")))
    # one admission line per key a candidate consumes: its funds, and its day when a loss limit is set
    # (built by one explode, so the joined candidates are computed once)
    funds_key = F.struct(F.lit("funds").alias("_k"), F.col("_balance").cast("decimal(18,2)").alias("cap"))
    day_key = F.struct(F.col("day").cast("string").alias("_k"), F.col("_loss_limit").cast("decimal(18,2)").alias("cap"))
    keyed = (r.filter(F.col("_pre").isNull() & F.col("_post").isNull())
             .select("request_id", "_seq", "player_id", F.col("stake").alias("amount"),
                     F.explode(F.when(F.col("_loss_limit").isNotNull(), F.array(funds_key, day_key))
                               .otherwise(F.array(funds_key))).alias("key"))
             .select("request_id", "_seq", "player_id", "amount", "key._k", "key.cap"))
    lines = keyed.select("request_id", "_seq", "player_id", "_k", "amount")
    caps = keyed.groupBy("player_id", "_k").agg(F.first("cap").alias("cap"))
    # _seq is epoch microseconds: admission segments follow the scans' segment width
    dec = admit(lines, caps, "request_id", "_seq", ["player_id", "_k"], "amount",
                bucket_rows=segment_seconds() * 1_000_000)
    zero = F.lit(0).cast("decimal(12,2)")
    r = (r.join(dec.select("request_id", "accepted"), "request_id", "left")
         .withColumn("_take", F.when(F.col("accepted"), F.col("stake")).otherwise(zero)))
    r = _used_before(r, ["player_id"], "_take", "_spent")
    # requests run in time order, so a player's days are contiguous: stakes placed earlier the
    # same day are the running total less its value at the day's first request (its minimum)
    day_start = r.groupBy("player_id", "day").agg(F.min("_spent").alias("_day_start"))
    r = (r.join(day_start, ["player_id", "day"])
         .withColumn("_spent_today", F.col("_spent") - F.col("_day_start")).drop("_day_start"))
    result = (F.when(F.col("_pre").isNotNull(), F.col("_pre"))
              .when(F.col("_balance") - F.col("_spent") < F.col("stake"), "insufficient_funds")
              .when(F.col("_loss_limit").isNotNull() & (F.col("_spent_today") + F.col("stake") > F.col("_loss_limit")),
                    "limit_reached")
              .when(F.col("_post").isNotNull(), F.col("_post")).otherwise("ok"))
    return r.select("request_id", "player_id", "event_id", "stake", "current_odds", result.alias("result"))


def _bet_result_sql(ub: str, udb: str) -> str:
    return (f"CASE WHEN j.pre IS NOT NULL THEN j.pre WHEN j.balance - ({ub}) < j.stake THEN 'insufficient_funds' "
            f"WHEN j.lim IS NOT NULL AND ({udb}) + j.stake > j.lim THEN 'limit_reached' "
            f"WHEN j.post IS NOT NULL THEN j.post ELSE 'ok' END")


_TAKE = "CASE WHEN w.result = 'ok' THEN w.stake ELSE 0 END"


@register("bet_decisions", adapters=("players_v", "matches_v", "money_events_v"), oracle="WITH RECURSIVE "
          + _SEL_SQL.removeprefix("WITH ") + f""",
req AS (SELECT event_id AS request_id, user_id AS player_id, event_id % (SELECT max(p_partkey) FROM part) AS match_id, CAST(1 + event_id % 3 AS INT) AS outcome,
               CAST(value AS DECIMAL(12,2)) AS stake, event_id, ts FROM events WHERE event_type = 'purchase'),
r2 AS (SELECT r.*, s.odds AS current_odds,
              CAST(s.odds * CAST(97 + r.event_id % 7 AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(7,3)) AS seen_odds
       FROM req r LEFT JOIN sel s ON s.selection_id = r.match_id * 7 + r.outcome),
funds AS (SELECT player_id, sum(amount) AS balance FROM money_events_v WHERE type = 'deposit' GROUP BY 1),
j AS (SELECT r2.request_id, r2.player_id, r2.match_id, r2.stake, r2.current_odds, coalesce(f.balance, 0) AS balance,
             p.daily_loss_limit AS lim, CAST(r2.ts AS DATE) AS day,
             CASE WHEN p.status IS NULL OR p.status <> 'active' THEN 'blocked'
                  WHEN r2.stake > p.max_stake THEN 'limit_reached' END AS pre,
             CASE WHEN NOT coalesce(m.status IN ('scheduled', 'live'), false) THEN 'market_suspended'
                  WHEN abs(r2.current_odds - r2.seen_odds) > r2.seen_odds * 0.02 THEN 'odds_changed' END AS post,
             row_number() OVER (PARTITION BY r2.player_id ORDER BY r2.ts, r2.request_id) AS rn
      FROM r2 LEFT JOIN players_v p ON p.id = r2.player_id LEFT JOIN matches_v m ON m.id = r2.match_id
      LEFT JOIN funds f ON f.player_id = r2.player_id),
walk AS (
  SELECT j.player_id, j.rn, j.day, j.stake, CAST(0 AS DECIMAL(38,2)) AS spent, CAST(0 AS DECIMAL(38,2)) AS spent_today,
         {_bet_result_sql("0", "0")} AS result
  FROM j WHERE j.rn = 1
  UNION ALL
  SELECT j.player_id, j.rn, j.day, j.stake, CAST(w.spent + {_TAKE} AS DECIMAL(38,2)),
         CAST(CASE WHEN j.day = w.day THEN w.spent_today + {_TAKE} ELSE 0 END AS DECIMAL(38,2)),
         {_bet_result_sql("w.spent + " + _TAKE, "CASE WHEN j.day = w.day THEN w.spent_today + " + _TAKE + " ELSE 0 END")}
  FROM walk w JOIN j ON j.player_id = w.player_id AND j.rn = w.rn + 1)
SELECT j.request_id, j.player_id, j.match_id AS event_id, j.stake, j.current_odds, w.result
FROM j JOIN walk w ON w.player_id = j.player_id AND w.rn = j.rn""")
def q_bet_decisions(spark, d):
    t = Tables(spark, d)
    funds = (t.money_events_v.filter(F.col("type") == "deposit").groupBy("player_id")
             .agg(F.sum("amount").alias("balance")))
    return decide_bets(_bet_requests(t), t.players_v, t.matches_v, funds)


def cashout_quotes(bets: DataFrame, legs: DataFrame, matches: DataFrame) -> DataFrame:
    """Open singles on live matches: ``stake x placed / current x 0.95``, cents half-even."""
    singles = bets.filter((F.col("status") == "open") & (F.col("legs") == 1)).select(
        F.col("id").alias("bet_id"), "stake")
    live = matches.filter(F.col("status") == "live").select(F.col("id").alias("event_id"),
                                                            implied_odds("id").alias("_odds"))
    j = singles.join(legs.select("bet_id", "event_id", "outcome", F.col("odds").alias("placed_odds")), "bet_id") \
        .join(live, "event_id")
    current = F.element_at("_odds", F.col("outcome"))
    # multiply first, divide last: the quotient of two exact decimals keeps a half-cent tie exact
    value = money(F.col("stake") * F.col("placed_odds") * F.lit(0.95).cast("decimal(3,2)") / current, 2)
    return j.select("bet_id", "event_id", "stake", "placed_odds", current.alias("current_odds"),
                    value.cast("decimal(14,2)").alias("cashout_value"))


@register("cashout_quotes", adapters=("bets_v", "legs_v", "matches_v"), oracle=_SEL_SQL + """,
single AS (SELECT bet_id FROM legs_v GROUP BY 1 HAVING count(*) = 1),
open_bets AS (SELECT s.bet_id FROM single s JOIN legs_v l ON l.bet_id = s.bet_id JOIN matches_v m ON m.id = l.event_id
              WHERE m.status NOT IN ('finished', 'settled'))
SELECT l.bet_id, l.event_id, b.stake, l.odds AS placed_odds, s.odds AS current_odds,
       CAST(CAST(CASE WHEN 2 * (x.n % x.m) > x.m THEN x.n // x.m + 1
                 WHEN 2 * (x.n % x.m) = x.m THEN x.n // x.m + (x.n // x.m) % 2
                 ELSE x.n // x.m END AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS cashout_value
FROM open_bets o JOIN legs_v l ON l.bet_id = o.bet_id JOIN bets_v b ON b.id = l.bet_id
JOIN matches_v m ON m.id = l.event_id AND m.status = 'live'
JOIN sel s ON s.selection_id = l.event_id * 7 + l.outcome,
LATERAL (SELECT CAST(b.stake * l.odds * CAST(0.95 AS DECIMAL(3,2)) * 10000000 AS HUGEINT) AS n,
                CAST(s.odds * 100 AS HUGEINT) * 1000 AS m) x""")
def q_cashout_quotes(spark, d):
    t = Tables(spark, d)
    return cashout_quotes(_bets_final(t), t.legs_v, t.matches_v)


def _used_before(rows: DataFrame, keys: list[str], take: str, out: str) -> DataFrame:
    """Accepted amount of earlier requests per key (requests ordered by ``_seq, request_id``);
    a segmented running sum, so a hot key is split by sequence buckets."""
    bucket = F.floor(F.col("_seq") / F.lit(3_600_000_000)).cast("long")
    r = running_sum(rows, keys, ["_seq", "request_id"], take, "_run", bucket)
    return r.withColumn(out, F.col("_run") - F.col(take)).drop("_run")


def decide_deposits(requests: DataFrame, players: DataFrame, decline_share: int = 5, seed: int = 42) -> DataFrame:
    """Deposits in request order against each player's daily deposit limit; the
    provider then declines ``decline_share`` % (a hashed draw per request).

    Only approved deposits count toward the limit, so a declined one consumes nothing: the
    requests that can be approved (not declined, limited player) go through set-based
    admission per (player, day); every request's verdict then reads the approved amount
    before it (``limit_reached`` wins over ``declined``, as the limit is checked first)."""
    lim = players.select(F.col("id").alias("player_id"), F.col("daily_deposit_limit").alias("_limit"))
    r = (requests.join(lim, "player_id", "left")
         .select("request_id", F.col("seq").alias("_seq"), "player_id", F.to_date("ts").alias("day"), "amount",
                 "_limit", (uniform(seed, 60, "request_id") < decline_share / 100).alias("_declined")))
    lines = r.filter(~F.col("_declined") & F.col("_limit").isNotNull())
    caps = lines.groupBy("player_id", "day").agg(F.first("_limit").alias("cap"))
    dec = admit(lines, caps, "request_id", "_seq", ["player_id", "day"], "amount")
    r = (r.join(dec.select("request_id", "accepted"), "request_id", "left")
         .withColumn("_take", F.when(F.col("accepted"), F.col("amount")).otherwise(F.lit(0).cast("decimal(14,2)"))))
    r = _used_before(r, ["player_id", "day"], "_take", "_used")
    over = F.col("_limit").isNotNull() & (F.col("_used") + F.col("amount") > F.col("_limit"))
    return r.select("request_id", F.when(over, "limit_reached").when(F.col("_declined"), "declined")
                    .otherwise("ok").alias("result"))


@register("deposit_decisions", adapters=("money_events_v", "players_v"), oracle=f"""WITH RECURSIVE j AS (SELECT d.id AS request_id, d.player_id, CAST(d.created_at AS DATE) AS day, d.amount, p.daily_deposit_limit AS lim,
             {uniform_sql(42, 60, "d.id")} < 0.05e0 AS declined,
             row_number() OVER (PARTITION BY d.player_id, CAST(d.created_at AS DATE) ORDER BY d.id) AS rn
      FROM money_events_v d LEFT JOIN players_v p ON p.id = d.player_id WHERE d.type = 'deposit'),
walk AS (
  SELECT player_id, day, rn, amount, CAST(0 AS DECIMAL(38,2)) AS used,
         CASE WHEN lim IS NOT NULL AND amount > lim THEN 'limit_reached' WHEN declined THEN 'declined' ELSE 'ok' END AS result
  FROM j WHERE rn = 1
  UNION ALL
  SELECT j.player_id, j.day, j.rn, j.amount,
         CAST(w.used + CASE WHEN w.result = 'ok' THEN w.amount ELSE 0 END AS DECIMAL(38,2)),
         CASE WHEN j.lim IS NOT NULL AND w.used + CASE WHEN w.result = 'ok' THEN w.amount ELSE 0 END + j.amount > j.lim
              THEN 'limit_reached' WHEN j.declined THEN 'declined' ELSE 'ok' END
  FROM walk w JOIN j ON j.player_id = w.player_id AND j.day = w.day AND j.rn = w.rn + 1)
SELECT j.request_id, w.result FROM j JOIN walk w ON w.player_id = j.player_id AND w.day = j.day AND w.rn = j.rn""")
def q_deposit_decisions(spark, d):
    t = Tables(spark, d)
    req = t.money_events_v.filter(F.col("type") == "deposit").select(
        F.col("id").alias("request_id"), F.col("id").alias("seq"), "player_id", F.col("created_at").alias("ts"),
        F.col("amount"))
    return decide_deposits(req, t.players_v)


def decide_withdrawals(requests: DataFrame, wallets: DataFrame, players: DataFrame, minimum: float = 10) -> DataFrame:
    """Every request in id order: blocked without a wallet, kyc_required unless verified, amount
    clamped to the balance that earlier accepted requests left, insufficient_funds under the minimum.

    Requests below the minimum never take anything, and once the balance is below it no later one
    does. So the balance before a request is the wallet less the earlier requests of at least the
    minimum: one segmented running sum, no walk over the requests.
    """
    asked = requests.withColumn("_able", F.when(F.col("requested") >= minimum, F.col("requested")).otherwise(0).cast(MONEY))
    bucket = F.floor(F.col("request_id") / F.lit(1_000_000)).cast("long")
    asked = running_sum(asked, ["player_id"], ["request_id"], "_able", "_run", bucket)
    j = asked.join(wallets, "player_id", "left").join(
        players.select(F.col("id").alias("player_id"), "kyc_status"), "player_id", "left")
    amount = F.least(F.col("balance") - (F.col("_run") - F.col("_able")), F.col("requested"))
    return j.select("player_id", "request_id",
                    F.when(F.col("balance").isNull(), "blocked").when(F.col("kyc_status") != "verified", "kyc_required")
                    .when(amount < minimum, "insufficient_funds").otherwise("ok").alias("result"),
                    F.when(F.col("balance").isNotNull() & (F.col("kyc_status") == "verified") & (amount >= minimum),
                           amount).cast(MONEY).alias("amount"))


@register("withdrawal_decisions", adapters=("money_events_v", "players_v"), oracle="""WITH RECURSIVE w AS (SELECT p.id AS player_id, coalesce(sum(m.amount), 0) AS balance FROM players_v p
      LEFT JOIN money_events_v m ON m.player_id = p.id AND m.account = 'cash' GROUP BY 1),
j AS (SELECT r.id, r.player_id, CAST(-r.amount AS DECIMAL(38,2)) AS requested, w.balance, p.kyc_status,
             row_number() OVER (PARTITION BY r.player_id ORDER BY r.id) AS rn
      FROM money_events_v r LEFT JOIN w ON w.player_id = r.player_id LEFT JOIN players_v p ON p.id = r.player_id
      WHERE r.type = 'withdrawal'),
walk AS (
  SELECT player_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS request_id, CAST(any_value(balance) AS DECIMAL(38,2)) AS funds,
         CAST(NULL AS VARCHAR) AS result, CAST(NULL AS DECIMAL(38,2)) AS amount
  FROM j GROUP BY player_id
  UNION ALL
  SELECT j.player_id, j.rn, j.id,
         CAST(CASE WHEN j.kyc_status = 'verified' AND least(k.funds, j.requested) >= 10 THEN k.funds - least(k.funds, j.requested)
              ELSE k.funds END AS DECIMAL(38,2)),
         CASE WHEN k.funds IS NULL THEN 'blocked' WHEN j.kyc_status <> 'verified' THEN 'kyc_required'
              WHEN least(k.funds, j.requested) < 10 THEN 'insufficient_funds' ELSE 'ok' END,
         CAST(CASE WHEN k.funds IS NOT NULL AND j.kyc_status = 'verified' AND least(k.funds, j.requested) >= 10
              THEN least(k.funds, j.requested) END AS DECIMAL(38,2))
  FROM walk k JOIN j ON j.player_id = k.player_id AND j.rn = k.rn + 1)
SELECT player_id, request_id, result, amount FROM walk WHERE rn > 0""")
def q_withdrawal_decisions(spark, d):
    from tillbook.plans.sportsbook import wallet_balances

    t = Tables(spark, d)
    req = t.money_events_v.filter(F.col("type") == "withdrawal").select(
        "player_id", F.col("id").alias("request_id"), (-F.col("amount")).alias("requested"))
    return decide_withdrawals(req, wallet_balances(t.players_v, t.money_events_v), t.players_v)


# ---- M08 withdrawal payout ----------------------------------------------------------------------------

def pay_withdrawals(payments: DataFrame, as_of: str, n: int = 200, declined=None):
    """Pending withdrawals older than a minute, oldest ``n``: paid, or declined (3%) with a
    reversal ledger row that returns the money. Returns (payment outcomes, reversal rows)."""
    declined = declined if declined is not None else (F.pmod(F.xxhash64("id"), F.lit(100)) < 3)
    batch = (payments.filter((F.col("status") == "pending")
                             & (F.col("created_at") < ts_lit(as_of) - F.make_dt_interval(mins=F.lit(1))))
             .orderBy("created_at", "id").limit(n).withColumn("_declined", declined))
    out = batch.select("id", "player_id", "amount",
                       F.when(F.col("_declined"), "declined").otherwise("paid").alias("status"),
                       F.when(~F.col("_declined"), F.concat(F.lit("PSP-W-"), F.col("id").cast("string")))
                       .alias("provider_ref"))
    reversals = batch.filter("_declined").select("player_id", F.lit("withdrawal_reversal").alias("type"),
                                                 F.lit("cash").alias("account"), "amount",
                                                 F.col("id").alias("reference_id"))
    return out, reversals


@register("withdrawal_payouts", adapters=("money_events_v",), oracle=f"""
WITH b AS (SELECT id, player_id, -amount AS amount FROM money_events_v WHERE type = 'withdrawal'
             AND created_at < TIMESTAMP '{BOOK_AS_OF}' - INTERVAL 1 MINUTE ORDER BY created_at, id LIMIT 200)
SELECT id, player_id, amount, CASE WHEN id % 33 = 0 THEN 'declined' ELSE 'paid' END AS status,
       CASE WHEN id % 33 <> 0 THEN 'PSP-W-' || CAST(id AS VARCHAR) END AS provider_ref FROM b""")
def q_withdrawal_payouts(spark, d):
    m = Tables(spark, d).money_events_v.filter(F.col("type") == "withdrawal").select(
        "id", "player_id", (-F.col("amount")).alias("amount"), "created_at", F.lit("pending").alias("status"))
    out, _ = pay_withdrawals(m, BOOK_AS_OF, declined=(F.col("id") % 33 == 0))
    return out


# ---- M22 public pages -----------------------------------------------------------------------------------

def competition_pages(matches: DataFrame, n: int = 20) -> DataFrame:
    """Each competition's next ``n`` scheduled/live matches with their match-result odds."""
    upcoming = last_n(matches.filter(F.col("status").isin("scheduled", "live")), ["competition_id"], ["id"], n)
    sel = build_selections(upcoming.drop("rn")).filter(F.col("market") == "match_result")
    return sel.join(upcoming.select(F.col("id").alias("event_id"), "competition_id", "status"), "event_id") \
        .select("competition_id", "event_id", "status", "selection_id", "name", "odds")


@register("competition_pages", adapters=("matches_v",), oracle=_SEL_SQL + """,
up AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY competition_id ORDER BY id) AS rn FROM matches_v
                      WHERE status IN ('scheduled', 'live')) WHERE rn <= 20)
SELECT up.competition_id, s.event_id, up.status, s.selection_id, s.name, s.odds
FROM up JOIN sel s ON s.event_id = up.id WHERE s.market = 'match_result'""")
def q_competition_pages(spark, d):
    return competition_pages(Tables(spark, d).matches_v)


def bet_history(bets: DataFrame, n: int = 20) -> DataFrame:
    """Each player's last ``n`` bets."""
    return last_n(bets, ["player_id"], [F.col("placed_at").desc(), F.col("id").desc()], n).select(
        "player_id", "id", "type", "stake", "total_odds", "status", "payout", "placed_at",
        F.col("rn").cast("bigint").alias("rn"))


@register("bet_history", adapters=("bets_v", "legs_v", "matches_v"), oracle="""
SELECT player_id, id, rn FROM (SELECT b.player_id, b.id,
       row_number() OVER (PARTITION BY b.player_id ORDER BY b.placed_at DESC, b.id DESC) AS rn
       FROM bets_v b WHERE b.id IN (SELECT bet_id FROM legs_v)) WHERE rn <= 20""")
def q_bet_history(spark, d):
    return bet_history(_bets_final(Tables(spark, d))).select("player_id", "id", "rn")


def event_pages(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """M22 event page of every match: competition, both team names, score, and every market's
    selections with their odds (the page's two statements joined on the match)."""
    from tillbook.plans.relations import with_teams

    hdr = with_teams(matches.select("id", "competition_id", "status", "home_score", "away_score",
                                    (F.col("id") % 25).cast("int").alias("home_team_id"),
                                    ((F.col("id") + 1 + F.col("id") % 24) % 25).cast("int").alias("away_team_id")),
                     teams)
    sel = build_selections(matches).select("event_id", "selection_id", "market", "name", "odds")
    return hdr.join(sel, F.col("event_id") == F.col("id")).select(
        "event_id", "competition_id", "status", "home_score", "away_score", "home_team", "away_team",
        "selection_id", "market", "name", "odds")


@register("event_pages", adapters=("matches_v",), oracle=_SEL_SQL + """,
hdr AS (SELECT m.id, m.competition_id, m.status, m.home_score, m.away_score, h.n_name AS home_team, a.n_name AS away_team
        FROM matches_v m JOIN nation h ON h.n_nationkey = m.id % 25 JOIN nation a ON a.n_nationkey = (m.id + 1 + m.id % 24) % 25)
SELECT hdr.id AS event_id, hdr.competition_id, hdr.status, hdr.home_score, hdr.away_score, hdr.home_team, hdr.away_team,
       s.selection_id, s.market, s.name, s.odds
FROM hdr JOIN sel s ON s.event_id = hdr.id""")
def q_event_pages(spark, d):
    t = Tables(spark, d)
    return event_pages(t.matches_v, t.nation)


def wallet_pages(ledger: DataFrame, n: int = 20) -> DataFrame:
    """M22 wallet page of every player: cash and bonus balance, and the last ``n`` ledger rows
    with the balance after each (W03 segmented running sum, W05 last-n with a partial
    WindowGroupLimit before the shuffle)."""
    run = running_sum(ledger, ["player_id", "account"], ["created_at", "id"], "amount", "balance_after",
                      segment_bucket("created_at"))
    last = last_n(run, ["player_id"], [F.col("created_at").desc(), F.col("id").desc()], n)
    wallet = ledger.groupBy("player_id").agg(
        F.sum(F.when(F.col("account") == "cash", F.col("amount")).otherwise(0)).cast("decimal(38,2)").alias("balance"),
        F.sum(F.when(F.col("account") == "bonus", F.col("amount")).otherwise(0)).cast("decimal(38,2)")
        .alias("bonus_balance"))
    return last.join(wallet, "player_id").select(
        "player_id", "balance", "bonus_balance", "id", "type", "account", "amount",
        F.col("balance_after").cast("decimal(38,2)").alias("balance_after"), "created_at",
        F.col("rn").cast("bigint").alias("rn"))


@register("wallet_pages", adapters=("money_events_v",), oracle="""
WITH r AS (SELECT *, CAST(sum(amount) OVER (PARTITION BY player_id, account ORDER BY created_at, id ROWS UNBOUNDED PRECEDING)
                          AS DECIMAL(38,2)) AS balance_after,
                  row_number() OVER (PARTITION BY player_id ORDER BY created_at DESC, id DESC) AS rn
           FROM money_events_v),
w AS (SELECT player_id, CAST(sum(CASE WHEN account = 'cash' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS balance,
             CAST(sum(CASE WHEN account = 'bonus' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS bonus_balance
      FROM money_events_v GROUP BY 1)
SELECT r.player_id, w.balance, w.bonus_balance, r.id, r.type, r.account, r.amount, r.balance_after, r.created_at,
       CAST(r.rn AS BIGINT) AS rn
FROM r JOIN w ON w.player_id = r.player_id WHERE r.rn <= 20""")
def q_wallet_pages(spark, d):
    return wallet_pages(Tables(spark, d).money_events_v)


def leaderboard_page(board: DataFrame, players: DataFrame, n: int = 100) -> DataFrame:
    """M22 weekly leaderboard page: the first ``n`` positions with the players' names."""
    names = players.select(F.col("id").alias("player_id"), "username")
    return board.filter(F.col("position") <= n).join(names, "player_id").select(
        "period", "position", "points", "player_id", "username")


def _leaderboard_page_oracle() -> str:
    from tillbook.plans.registry import ORACLES
    from tillbook.sources.adapters import with_adapters

    return with_adapters(f"""SELECT l.period, l.position, l.points, l.player_id, p.username
FROM (
{ORACLES["leaderboard"]}
) l JOIN players_v p ON p.id = l.player_id WHERE l.position <= 100""", "players_v")


@register("leaderboard_page", oracle=_leaderboard_page_oracle())
def q_leaderboard_page(spark, d):
    from tillbook.plans.sportsbook import leaderboard
    from tillbook.session import ORDERS_AS_OF

    t = Tables(spark, d)
    return leaderboard_page(leaderboard(_bets_final(t), ORDERS_AS_OF), t.players_v)
