"""Sportsbook builds: bets and legs (B21, J06, J07), fixture top-up (B25), the live page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import pick, skewed_key, skewed_key_sql, uniform, uniform_sql
from tillbook.plans.book_jobs import _SEL_SQL, build_selections
from tillbook.plans.build import fan_out
from tillbook.plans.registry import register
from tillbook.plans.shop_build import insert_ignore
from tillbook.sources.adapters import Tables

# Stakes and channels the bettors pick from.
STAKES = (2, 5, 5, 10, 10, 10, 20, 25, 50, 100)
CHANNELS = ("mobile", "mobile", "web", "app")


def build_bets(keys: DataFrame, players: DataFrame, matches: DataFrame, seed: int = 42):
    """A bet per key (bettors skewed, k = 2.2), 70% singles, else 2-4 legs. The leg numbers
    come from ``explode(sequence(1, n))`` (J06: no theta join), each leg's selection is found by
    the computed key ``match x 7 + outcome`` (J07), and a leg repeating a selection of its bet
    is dropped (B07). Returns (bets, legs)."""
    pb = players.agg(F.min("id").alias("p_lo"), F.count(F.lit(1)).alias("p_n"))
    mb = matches.agg(F.min("id").alias("m_lo"), F.count(F.lit(1)).alias("m_n"))
    p_lo, p_n = pb.select("p_lo").scalar(), pb.select("p_n").scalar()   # scalar subqueries (J05)
    m_lo, m_n = mb.select("m_lo").scalar(), mb.select("m_n").scalar()
    b = F.col("id")
    bets = keys.select(
        F.col("g").alias("id"),
        skewed_key(uniform(seed, 50, "g"), p_lo, p_n, 2.2).alias("player_id"),
        pick(F.floor(uniform(seed, 51, "g") * 10), STAKES).cast("decimal(12,2)").alias("stake"),
        pick(F.floor(uniform(seed, 52, "g") * 4), CHANNELS).alias("channel"))
    n_legs = F.when(b % 10 < 7, F.lit(1)).otherwise(2 + b % 3)
    legs = (fan_out(bets.select("id"), n_legs, "leg")
            .select(F.col("id").alias("bet_id"), "leg",
                    (m_lo + F.floor(uniform(seed, 53, "id", "leg") * m_n)).cast("long").alias("event_id"),
                    (1 + F.floor(uniform(seed, 54, "id", "leg") * 7)).cast("int").alias("outcome")))
    sel = build_selections(matches).select("selection_id", "odds")
    legs = legs.withColumn("selection_id", F.col("event_id") * 7 + F.col("outcome")).join(sel, "selection_id")
    legs = insert_ignore(legs.filter(F.lit(False)), legs, ["bet_id", "selection_id"], ["leg"])
    return bets, legs.select("bet_id", "selection_id", "event_id", "odds")


@register("bets_build", adapters=("matches_v",), oracle=_SEL_SQL + f""",
mb AS (SELECT min(id) AS lo, count(*) AS n FROM matches_v),
lg AS (SELECT o_orderkey AS bet_id,
              unnest(generate_series(1, CASE WHEN o_orderkey % 10 < 7 THEN 1 ELSE 2 + o_orderkey % 3 END)) AS leg
       FROM orders),
lp AS (SELECT bet_id, leg, CAST(mb.lo + floor({uniform_sql(42, 53, "bet_id", "leg")} * mb.n) AS BIGINT) AS event_id,
              CAST(1 + floor({uniform_sql(42, 54, "bet_id", "leg")} * 7) AS INT) AS outcome
       FROM lg, mb)
SELECT lp.bet_id, sel.selection_id, arg_min(lp.event_id, lp.leg) AS event_id, arg_min(sel.odds, lp.leg) AS odds
FROM lp JOIN sel ON sel.selection_id = lp.event_id * 7 + lp.outcome
GROUP BY 1, 2""")
def q_bets_build(spark, d):
    t = Tables(spark, d)
    _, legs = build_bets(t.orders.select(F.col("o_orderkey").alias("g")), t.players_v, t.matches_v)
    return legs


@register("bet_rows_build", adapters=("players_v",), oracle=f"""
WITH pb AS (SELECT min(id) AS lo, count(*) AS n FROM players_v)
SELECT o_orderkey AS id, {skewed_key_sql(uniform_sql(42, 50, "o_orderkey"), "pb.lo", "pb.n", 2.2)} AS player_id,
       CAST({list(STAKES)!r}[1 + CAST(floor({uniform_sql(42, 51, "o_orderkey")} * 10) AS INT)] AS DECIMAL(12,2)) AS stake,
       {list(CHANNELS)!r}[1 + CAST(floor({uniform_sql(42, 52, "o_orderkey")} * 4) AS INT)] AS channel
FROM orders, pb""")
def q_bet_rows_build(spark, d):
    """The bets themselves: skewed bettors, stakes and channels."""
    t = Tables(spark, d)
    return build_bets(t.orders.select(F.col("o_orderkey").alias("g")), t.players_v, t.matches_v)[0]


def top_up_fixtures(matches: DataFrame, target: int) -> DataFrame:
    """Add scheduled matches until ``target`` are scheduled: ids after the largest, competition and
    teams from id arithmetic (never the same team twice), kick-offs 10 minutes apart, opening odds (G04).

    Only the largest id and the shortfall, two numbers, reach the driver. The new ids are a range that
    Spark deals out over its tasks, each of which knows its own part of it.
    """
    now = matches.agg(F.max("id").alias("last"), F.count_if(F.col("status") == "scheduled").alias("scheduled")).first()
    last = now["last"] or 0
    n = F.col("id")
    comp = 1 + n % 12
    home_ix = (n * 7) % 20
    return matches.sparkSession.range(last + 1, last + 1 + max(0, target - now["scheduled"])).select(
        "id", comp.cast("int").alias("competition_id"),
        ((comp - 1) * 20 + 1 + home_ix).cast("int").alias("home_team_id"),
        ((comp - 1) * 20 + 1 + (home_ix + 1 + n % 19) % 20).cast("int").alias("away_team_id"),
        ((n - F.lit(last)) * 10).cast("int").alias("starts_in_minutes"), F.lit("scheduled").alias("status"),
        F.lit(0).alias("home_score"), F.lit(0).alias("away_score"))


@register("fixture_top_up", adapters=("matches_v",), oracle="""
WITH need AS (SELECT max(id) AS max_id, count(*) AS n, count(*) FILTER (WHERE status = 'scheduled') AS scheduled
              FROM matches_v),
new AS (SELECT max_id + i AS id, i FROM need, range(1, CAST(floor(n * 0.15) - scheduled AS BIGINT) + 1) r(i))
SELECT s.event_id, s.selection_id, s.market, s.name, s.odds, CAST(1 + new.id % 12 AS INT) AS competition_id,
       CAST(new.i * 10 AS INT) AS starts_in_minutes
FROM new JOIN (
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
            ELSE 1.0 - (0.35 + 0.35 * ((m.id * 1299709) % 1000) / 1000.0) END)), 2)) AS DECIMAL(7,2)) AS odds
  FROM (SELECT max_id + i AS id FROM need, range(1, CAST(floor(n * 0.15) - scheduled AS BIGINT) + 1) r(i)) m,
       range(1, 8) r(k)) s ON s.event_id = new.id""")
def q_fixture_top_up(spark, d):
    """The new fixtures with their seven opening odds each."""
    matches = Tables(spark, d).matches_v
    new = top_up_fixtures(matches, matches.count() * 15 // 100)
    sel = build_selections(new)
    return sel.join(new.select(F.col("id").alias("event_id"), "competition_id", "starts_in_minutes"), "event_id") \
        .select("event_id", "selection_id", "market", "name", "odds", "competition_id", "starts_in_minutes")


def live_page(matches: DataFrame, n: int = 90) -> DataFrame:
    """Every live match with its match-result odds, first ``n`` rows by match and selection."""
    live = matches.filter(F.col("status") == "live")
    sel = build_selections(live).filter(F.col("market") == "match_result")
    return sel.select("event_id", "selection_id", "name", "odds").orderBy("event_id", "selection_id").limit(n)


@register("live_page", adapters=("matches_v",), oracle="""
SELECT id AS event_id, id * 7 + k AS selection_id, ['home','draw','away'][k] AS name,
       CAST(greatest(1.01, round(1.0 / (1.06 * (CASE k
            WHEN 1 THEN 0.15 + 0.6 * ((id * 7919) % 1000) / 1000.0
            WHEN 2 THEN 1.0 - (0.15 + 0.6 * ((id * 7919) % 1000) / 1000.0) - (1.0 - (0.15 + 0.6 * ((id * 7919) % 1000) / 1000.0)) * 0.62
            ELSE (1.0 - (0.15 + 0.6 * ((id * 7919) % 1000) / 1000.0)) * 0.62 END)), 2)) AS DECIMAL(7,2)) AS odds
FROM matches_v, range(1, 4) r(k) WHERE status = 'live' ORDER BY 1, 2 LIMIT 90""")
def q_live_page(spark, d):
    return live_page(Tables(spark, d).matches_v)
