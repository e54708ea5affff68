"""Sportsbook reports (A09-A25), bet finalisation (B22, A14-A16, M07) and public pages.

Legs are joined to their match by the denormalised ``event_id`` (no selections/markets
join needed). Per-bet leg lists are bounded by the product rule (1 to 4 legs), which is the
only reason a ``collect_list`` appears (the exact odds product, A14b).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.functions import SELECTION_NAMES, money, selection_result, signed, trunc_ts, ts_lit, week_start
from tillbook.plans.registry import register
from tillbook.session import EVENTS_AS_OF, ORDERS_AS_OF
from tillbook.sources.adapters import Tables

MONEY = "decimal(38,2)"
# Match states, in life-cycle order.
MATCH_STATES = ("scheduled", "live", "finished", "settled", "cancelled")


def _since(as_of: str, days: int = 0, hours: int = 0):
    return ts_lit(as_of) - F.make_dt_interval(days=F.lit(days), hours=F.lit(hours))


# ---- M07 / B22: leg results and finalised bets ---------------------------------------------

def leg_results(legs: DataFrame, matches: DataFrame) -> DataFrame:
    """Each leg with its selection name and result: decided once its match is finished."""
    names = F.array(*[F.lit(n) for _, n in SELECTION_NAMES])
    m = matches.select(F.col("id").alias("m_id"), "status", "home_score", "away_score", "competition_id")
    j = legs.join(m, F.col("m_id") == F.col("event_id"))
    name = F.element_at(names, F.col("outcome"))
    result = F.when(F.col("status").isin("finished", "settled"),
                    selection_result(name, "home_score", "away_score")).otherwise(F.lit("pending"))
    return j.select("bet_id", "event_id", "selection_id", "odds", "competition_id", name.alias("selection"),
                    result.alias("result"))


def odds_product(odds_list) -> F.Column:
    """Exact product of decimal odds (DECIMAL(28,12) accumulator), capped at 1000, 3 digits half-even."""
    prod = F.aggregate(odds_list, F.lit(1).cast("decimal(28,12)"),
                       lambda acc, x: (acc * x).cast("decimal(28,12)"))
    return money(F.least(prod, F.lit(1000).cast("decimal(28,12)")), 3).cast("decimal(10,3)")


def odds_product_fp(odds) -> F.Column:
    """``exp(sum(ln(odds)))`` capped at 1000 (double); an aggregate expression."""
    return F.least(F.lit(1000.0), F.exp(F.sum(F.ln(F.col(odds).cast("double")))))


def finalise_bets(bets: DataFrame, legs: DataFrame, matches: DataFrame) -> DataFrame:
    """Type, total odds, potential payout, status and payout of every bet from its legs.

    Lost beats pending (X9): a bet with a lost leg is lost even while other legs are open;
    won needs every leg decided. Payouts round half-even to cents (X3).
    """
    lr = leg_results(legs, matches)
    per_bet = lr.groupBy("bet_id").agg(
        F.count(F.lit(1)).alias("legs"),
        F.count_if(F.col("result") == "lost").alias("lost"),
        F.count_if(F.col("result") == "pending").alias("pending"),
        F.collect_list("odds").alias("_odds"))
    total = odds_product(F.col("_odds"))
    status = F.when(F.col("lost") > 0, "lost").when(F.col("pending") == 0, "won").otherwise("open")
    potential = money(F.col("stake") * F.col("total_odds"), 2).cast("decimal(14,2)")
    return (bets.join(per_bet, F.col("bet_id") == F.col("id"))
            .select("id", "player_id", "stake", "placed_at", "legs", "lost", "pending",
                    F.when(F.col("legs") == 1, "single").otherwise("accumulator").alias("type"),
                    total.alias("total_odds"), status.alias("status"))
            .withColumn("potential_payout", potential)
            .withColumn("payout", F.when(F.col("status") == "won", F.col("potential_payout"))
                        .when(F.col("status") == "lost", F.lit(0).cast("decimal(14,2)"))))


# ---- regulatory report A09-A13 --------------------------------------------------------------

def ggr_daily(bets: DataFrame, players: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    b = bets.filter(F.col("placed_at") >= _since(as_of, days))
    return (b.join(players.select(F.col("id").alias("pid"), "country_code"), F.col("pid") == F.col("player_id"))
            .groupBy(F.to_date("placed_at").alias("day"), "country_code")
            .agg(F.count(F.lit(1)).alias("bets"), F.sum("stake").cast(MONEY).alias("turnover"),
                 F.sum(F.coalesce("payout", F.lit(0))).cast(MONEY).alias("payouts"))
            .withColumn("ggr", (F.col("turnover") - F.col("payouts")).cast(MONEY)))


def match_starts(matches: DataFrame) -> DataFrame:
    """The fixture's start of every match: over the 60 days before the report and the two after it."""
    return matches.withColumn("starts_at", ts_lit(ORDERS_AS_OF) + F.make_dt_interval(
        days=(2 - F.col("id") * 13 % 62).cast("int"), hours=(F.col("id") % 24).cast("int")))


def competition_turnover(legs: DataFrame, bets: DataFrame, matches: DataFrame, as_of: str,
                         days: int = 30) -> DataFrame:
    """Turnover and legs per competition, of the matches that start from ``days`` before ``as_of`` on; the stake
    counts once per leg. The matches choose the legs before the bets are joined."""
    m = matches.filter(F.col("starts_at") >= _since(as_of, days)).select(F.col("id").alias("m_id"), "competition_id")
    b = bets.select(F.col("id").alias("b_id"), "stake")
    return (legs.join(m, F.col("m_id") == F.col("event_id")).join(b, F.col("b_id") == F.col("bet_id"))
            .groupBy("competition_id")
            .agg(F.count(F.lit(1)).alias("legs"), F.sum("stake").cast(MONEY).alias("turnover")))


def self_excluded_bets(players: DataFrame, bets: DataFrame, as_of: str, days: int = 1) -> DataFrame:
    p = players.filter(F.col("status") == "self_excluded").select("id", "username")
    b = bets.filter(F.col("placed_at") >= _since(as_of, days)).select(F.col("id").alias("bet_id"), "player_id")
    return (p.join(b, F.col("player_id") == F.col("id")).groupBy("id", "username")
            .agg(F.count("bet_id").alias("bets")))


def large_deposits(ledger: DataFrame, as_of: str, limit: float = 2000, days: int = 1) -> DataFrame:
    """Deposits above ``limit`` within the window (HAVING on a partial aggregate)."""
    return (ledger.filter((F.col("type") == "deposit") & (F.col("created_at") >= _since(as_of, days)))
            .groupBy("player_id").agg(F.count(F.lit(1)).alias("deposits"), F.sum("amount").cast(MONEY).alias("total"))
            .filter(F.col("total") > F.lit(limit)))


def open_liability(bets: DataFrame, legs: DataFrame, n: int = 100) -> DataFrame:
    """Open liability per match, top ``n`` (match id breaks ties)."""
    b = bets.filter(F.col("status") == "open").select(F.col("id").alias("b_id"), "potential_payout")
    return (legs.join(b, F.col("b_id") == F.col("bet_id")).groupBy("event_id")
            .agg(F.count(F.lit(1)).alias("open_bets"), F.sum("potential_payout").cast(MONEY).alias("liability"))
            .orderBy(F.col("liability").desc(), "event_id").limit(n))


# ---- A17-A25 --------------------------------------------------------------------------------

def status_counts(df: DataFrame, domain: tuple[str, ...], col: str = "status") -> DataFrame:
    """Rows per status, zero-filled over the whole domain (a literal list, broadcast: bounded)."""
    dom = df.sparkSession.createDataFrame([(s,) for s in domain], f"{col} string")
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return (F.broadcast(dom).join(counts, col, "left")
            .select(col, F.coalesce("n", F.lit(0)).cast("bigint").alias("rows")))


def wallet_balances(players: DataFrame, ledger: DataFrame, account: str = "cash") -> DataFrame:
    """balance = sum of the ledger per player; players without rows hold 0 (pre-aggregated)."""
    sums = (ledger.filter(F.col("account") == account).groupBy("player_id")
            .agg(F.sum("amount").alias("s")))
    return (players.select("id").join(sums, F.col("player_id") == F.col("id"), "left")
            .select(F.col("id").alias("player_id"), F.coalesce("s", F.lit(0)).cast(MONEY).alias("balance")))


def reconcile(wallets: DataFrame, ledger: DataFrame) -> DataFrame:
    """Wallets vs ledger per player x account, full outer join, AGREE / MISMATCH."""
    led = ledger.groupBy("player_id", "account").agg(F.sum("amount").cast(MONEY).alias("ledger"))
    w = wallets.select("player_id", "account", F.col("balance").cast(MONEY).alias("wallet"))
    j = w.join(led, ["player_id", "account"], "full")
    agree = F.coalesce("wallet", F.lit(0)) == F.coalesce("ledger", F.lit(0))
    return j.select("player_id", "account", F.coalesce("wallet", F.lit(0)).cast(MONEY).alias("wallet"),
                    F.coalesce("ledger", F.lit(0)).cast(MONEY).alias("ledger"),
                    F.when(agree, "AGREE").otherwise("MISMATCH").alias("verdict"))


def daily_usage(ledger: DataFrame) -> DataFrame:
    """Stakes and deposits per player and day (daily loss / deposit limits)."""
    return (ledger.groupBy("player_id", F.to_date("created_at").alias("day"))
            .agg(F.sum(F.when(F.col("type") == "stake", -F.col("amount")).otherwise(0)).cast(MONEY).alias("stakes"),
                 F.sum(F.when(F.col("type") == "deposit", F.col("amount")).otherwise(0)).cast(MONEY).alias("deposits")))


def mission_qualifiers(ledger: DataFrame, min_stake: float) -> DataFrame:
    """Players whose stakes in an hour reach the minimum."""
    return (ledger.filter(F.col("type") == "stake")
            .groupBy(trunc_ts("hour", "created_at").alias("period"), "player_id")
            .agg((-F.sum("amount")).cast(MONEY).alias("staked"))
            .filter(F.col("staked") >= F.lit(min_stake)))


def leaderboard(bets: DataFrame, as_of: str, n: int = 1000) -> DataFrame:
    """points = stakes + 2 x winnings of the week (MySQL SIGNED rounding, X5), top ``n``.

    The cut runs as TakeOrderedAndProject (per-task top-n, then a merge of n x tasks rows);
    positions are numbered only on those ``n`` rows, never by a global window.
    """
    period = week_start(ts_lit(as_of))
    pts = (bets.filter(F.col("placed_at") >= period.cast("timestamp_ntz"))
           .groupBy("player_id")
           .agg(signed(F.sum("stake") + 2 * F.sum(F.coalesce("payout", F.lit(0)))).alias("points"))
           .orderBy(F.col("points").desc(), "player_id").limit(n))
    w = Window.orderBy(F.col("points").desc(), "player_id")
    return pts.select(period.alias("period"), "player_id", "points",
                      F.row_number().over(w).cast("bigint").alias("position"))


# Ledger entry types.
LEDGER_TYPES = ("deposit", "withdrawal", "withdrawal_reversal", "stake", "win", "cashout", "bonus")


def money_flows(ledger: DataFrame) -> DataFrame:
    """Totals per entry type (pivot over all types of the ledger) and GGR = stakes - wins - cash-outs."""
    p = ledger.groupBy().pivot("type", list(LEDGER_TYPES)).agg(F.sum("amount"))
    cols = [F.coalesce(F.col(t), F.lit(0)).cast(MONEY).alias(f"{t}s") for t in LEDGER_TYPES]
    out = p.select(*cols)
    return out.withColumn("ggr", (-F.col("stakes") - F.col("wins") - F.col("cashouts")).cast(MONEY))


def settlement_summary(bets: DataFrame) -> DataFrame:
    return bets.groupBy("status").agg(F.count(F.lit(1)).alias("bets"),
                                      F.sum(F.coalesce("payout", F.lit(0))).cast(MONEY).alias("paid"))


# ---- registered queries -------------------------------------------------------------------

_LEG_RESULTS_SQL = """
leg_results AS (
  SELECT l.bet_id, l.event_id, l.selection_id, l.odds, m.competition_id,
         ['home','draw','away','over','under','yes','no'][l.outcome] AS selection,
         CASE WHEN m.status IN ('finished', 'settled') THEN
           CASE WHEN (l.outcome = 1 AND m.home_score > m.away_score) OR (l.outcome = 2 AND m.home_score = m.away_score)
                  OR (l.outcome = 3 AND m.home_score < m.away_score) OR (l.outcome = 4 AND m.home_score + m.away_score > 2)
                  OR (l.outcome = 5 AND m.home_score + m.away_score < 3)
                  OR (l.outcome = 6 AND m.home_score > 0 AND m.away_score > 0)
                  OR (l.outcome = 7 AND (m.home_score = 0 OR m.away_score = 0)) THEN 'won' ELSE 'lost' END
         ELSE 'pending' END AS result
  FROM legs_v l JOIN matches_v m ON m.id = l.event_id),
per_bet AS (
  SELECT bet_id, count(*) AS legs, count(*) FILTER (WHERE result = 'lost') AS lost,
         count(*) FILTER (WHERE result = 'pending') AS pending,
         CAST(round_even(least(list_reduce(list(CAST(odds AS DECIMAL(28,12))),
                                           lambda a, b: CAST(a * b AS DECIMAL(28,12))), 1000), 3) AS DECIMAL(10,3)) AS total_odds
  FROM leg_results GROUP BY bet_id),
bets_final AS (
  SELECT b.id, b.player_id, b.stake, b.placed_at, p.legs, p.lost, p.pending,
         CASE WHEN p.legs = 1 THEN 'single' ELSE 'accumulator' END AS type, p.total_odds,
         CASE WHEN p.lost > 0 THEN 'lost' WHEN p.pending = 0 THEN 'won' ELSE 'open' END AS status,
         CAST(round_even(b.stake * p.total_odds, 2) AS DECIMAL(14,2)) AS potential_payout,
         CASE WHEN p.lost > 0 THEN CAST(0 AS DECIMAL(14,2)) WHEN p.pending = 0
              THEN CAST(round_even(b.stake * p.total_odds, 2) AS DECIMAL(14,2)) END AS payout
  FROM bets_v b JOIN per_bet p ON p.bet_id = b.id)"""
_BETS = ("bets_v", "legs_v", "matches_v")


def _bets_final(t: Tables) -> DataFrame:
    return finalise_bets(t.bets_v, t.legs_v, t.matches_v)


@register("bets_final", adapters=_BETS, oracle=f"WITH {_LEG_RESULTS_SQL}\nSELECT * FROM bets_final")
def q_bets_final(spark, d):
    return _bets_final(Tables(spark, d))


@register("leg_results", adapters=("legs_v", "matches_v"), oracle=f"""WITH {_LEG_RESULTS_SQL.split('per_bet AS')[0].rstrip().rstrip(',')}
SELECT * FROM leg_results""")
def q_leg_results(spark, d):
    t = Tables(spark, d)
    return leg_results(t.legs_v, t.matches_v)


@register("odds_product_fp", adapters=("legs_v",), oracle="""
SELECT bet_id, round(least(1000, exp(sum(ln(CAST(odds AS DOUBLE))))), 8) AS total_odds_fp FROM legs_v GROUP BY bet_id""")
def q_odds_product_fp(spark, d):
    legs = Tables(spark, d).legs_v
    return legs.groupBy("bet_id").agg(F.round(odds_product_fp("odds"), 8).alias("total_odds_fp"))


@register("ggr_daily", adapters=_BETS + ("players_v",), oracle=f"""WITH {_LEG_RESULTS_SQL},
d AS (SELECT player_id, CAST(placed_at AS DATE) AS day, count(*) AS n, sum(stake) AS staked, sum(payout) AS paid
      FROM bets_final WHERE placed_at + INTERVAL 30 DAY >= TIMESTAMP '2001-08-02 00:00:00' GROUP BY ALL),
c AS (SELECT day, country_code, sum(n) AS n, sum(staked) AS staked, sum(ifnull(paid, 0)) AS paid
      FROM d JOIN players_v ON players_v.id = player_id GROUP BY ALL)
SELECT day, country_code, CAST(n AS BIGINT) AS bets, CAST(staked AS DECIMAL(38,2)) AS turnover, CAST(paid AS DECIMAL(38,2)) AS payouts,
       CAST(staked - paid AS DECIMAL(38,2)) AS ggr
FROM c""")
def q_ggr_daily(spark, d):
    t = Tables(spark, d)
    return ggr_daily(_bets_final(t), t.players_v, ORDERS_AS_OF)


@register("competition_turnover", adapters=("legs_v", "bets_v", "matches_v"), oracle="""
WITH m AS (SELECT id, competition_id, TIMESTAMP '2001-08-02 00:00:00' + to_days(CAST(2 - id * 13 % 62 AS INT)) + to_hours(CAST(id % 24 AS INT)) AS starts
           FROM matches_v),
per_match AS (SELECT event_id, count(*) AS n, sum(stake) AS staked FROM legs_v JOIN bets_v ON bets_v.id = bet_id GROUP BY 1)
SELECT competition_id, CAST(sum(n) AS BIGINT) AS legs, CAST(sum(staked) AS DECIMAL(38,2)) AS turnover
FROM m JOIN per_match ON event_id = m.id WHERE starts + INTERVAL 30 DAY >= TIMESTAMP '2001-08-02 00:00:00' GROUP BY 1""")
def q_competition_turnover(spark, d):
    t = Tables(spark, d)
    return competition_turnover(t.legs_v, t.bets_v, match_starts(t.matches_v), ORDERS_AS_OF)


@register("self_excluded_bets", adapters=("players_v", "bets_v"), oracle="""
WITH n AS (SELECT player_id, count(*) AS bets FROM bets_v
           WHERE placed_at + INTERVAL 365 DAY >= TIMESTAMP '2001-08-02 00:00:00' GROUP BY ALL)
SELECT id, username, bets FROM n JOIN players_v ON id = player_id AND status = 'self_excluded'""")
def q_self_excluded_bets(spark, d):
    t = Tables(spark, d)
    return self_excluded_bets(t.players_v, t.bets_v, ORDERS_AS_OF, days=365)


@register("large_deposits", adapters=("money_events_v",), oracle="""
SELECT player_id, count(*) AS deposits, CAST(sum(amount) AS DECIMAL(38,2)) AS total
FROM money_events_v WHERE type = 'deposit' AND created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY
GROUP BY player_id HAVING sum(amount) > 200""")
def q_large_deposits(spark, d):
    return large_deposits(Tables(spark, d).money_events_v, EVENTS_AS_OF, limit=200, days=10)


@register("open_liability", adapters=_BETS, oracle=f"""WITH {_LEG_RESULTS_SQL},
v AS (SELECT event_id, potential_payout FROM legs_v SEMI JOIN (SELECT id FROM bets_final WHERE lost = 0 AND pending > 0) o ON o.id = bet_id
      JOIN bets_final f ON f.id = bet_id)
SELECT event_id, count(*) AS open_bets, CAST(sum(potential_payout) AS DECIMAL(38,2)) AS liability
FROM v GROUP BY event_id QUALIFY row_number() OVER (ORDER BY liability DESC, event_id) <= 100""")
def q_open_liability(spark, d):
    t = Tables(spark, d)
    return open_liability(_bets_final(t), t.legs_v)


@register("match_status_counts", adapters=("matches_v",), oracle="""
SELECT d.status, CAST(count(m.id) AS BIGINT) AS rows
FROM (VALUES ('scheduled'), ('live'), ('finished'), ('settled'), ('cancelled')) d(status)
LEFT JOIN matches_v m ON m.status = d.status GROUP BY d.status""")
def q_match_status_counts(spark, d):
    return status_counts(Tables(spark, d).matches_v, MATCH_STATES)


@register("wallet_balances", adapters=("players_v", "money_events_v"), oracle="""
SELECT p.id AS player_id, CAST(coalesce(sum(m.amount), 0) AS DECIMAL(38,2)) AS balance
FROM players_v p LEFT JOIN money_events_v m ON m.player_id = p.id AND m.account = 'cash' GROUP BY p.id""")
def q_wallet_balances(spark, d):
    t = Tables(spark, d)
    return wallet_balances(t.players_v, t.money_events_v)


@register("daily_usage", adapters=("money_events_v",), oracle="""
SELECT player_id, CAST(created_at AS DATE) AS day,
       CAST(sum(CASE WHEN type = 'stake' THEN -amount ELSE 0 END) AS DECIMAL(38,2)) AS stakes,
       CAST(sum(CASE WHEN type = 'deposit' THEN amount ELSE 0 END) AS DECIMAL(38,2)) AS deposits
FROM money_events_v GROUP BY 1, 2""")
def q_daily_usage(spark, d):
    return daily_usage(Tables(spark, d).money_events_v)


@register("mission_qualifiers", adapters=("money_events_v",), oracle="""
SELECT date_trunc('hour', created_at) AS period, player_id, CAST(-sum(amount) AS DECIMAL(38,2)) AS staked
FROM money_events_v WHERE type = 'stake' GROUP BY 1, 2 HAVING -sum(amount) >= 100""")
def q_mission_qualifiers(spark, d):
    return mission_qualifiers(Tables(spark, d).money_events_v, 100)


@register("leaderboard", adapters=_BETS, oracle=f"""WITH {_LEG_RESULTS_SQL},
top AS (SELECT player_id, CAST(round(sum(stake) + 2 * sum(coalesce(payout, 0))) AS BIGINT) AS points
        FROM bets_final WHERE placed_at >= TIMESTAMP '2001-07-30 00:00:00'
        GROUP BY player_id ORDER BY points DESC, player_id LIMIT 1000)
SELECT DATE '2001-07-30' AS period, player_id, points,
       CAST(row_number() OVER (ORDER BY points DESC, player_id) AS BIGINT) AS position FROM top""")
def q_leaderboard(spark, d):
    return leaderboard(_bets_final(Tables(spark, d)), ORDERS_AS_OF)


@register("money_flows", adapters=("money_events_v",), oracle="""
SELECT CAST(coalesce(sum(amount) FILTER (WHERE type = 'deposit'), 0) AS DECIMAL(38,2)) AS deposits,
       CAST(coalesce(sum(amount) FILTER (WHERE type = 'stake'), 0) AS DECIMAL(38,2)) AS stakes,
       CAST(coalesce(sum(amount) FILTER (WHERE type = 'win'), 0) AS DECIMAL(38,2)) AS wins,
       CAST(coalesce(sum(amount) FILTER (WHERE type = 'withdrawal'), 0) AS DECIMAL(38,2)) AS withdrawals,
       CAST(coalesce(sum(amount) FILTER (WHERE type = 'bonus'), 0) AS DECIMAL(38,2)) AS bonuss,
       CAST(coalesce(sum(amount) FILTER (WHERE type = 'cashout'), 0) AS DECIMAL(38,2)) AS cashouts,
       CAST(coalesce(sum(amount) FILTER (WHERE type = 'withdrawal_reversal'), 0) AS DECIMAL(38,2)) AS withdrawal_reversals,
       CAST(-coalesce(sum(amount) FILTER (WHERE type IN ('stake', 'win', 'cashout')), 0) AS DECIMAL(38,2)) AS ggr
FROM money_events_v""")
def q_money_flows(spark, d):
    return money_flows(Tables(spark, d).money_events_v)


@register("settlement_summary", adapters=_BETS, oracle=f"""WITH {_LEG_RESULTS_SQL}
SELECT status, count(*) AS bets, CAST(sum(coalesce(payout, 0)) AS DECIMAL(38,2)) AS paid FROM bets_final GROUP BY 1""")
def q_settlement_summary(spark, d):
    return settlement_summary(_bets_final(Tables(spark, d)))
