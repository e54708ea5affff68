"""Settlement that is complete (M06): the first matches by their finish, with closed markets and matches and
the winners' wallets, whose ledger rows go through the idempotent intake (M16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import ts_lit
from tillbook.plans.book_jobs import apply_ledger, settle
from tillbook.plans.registry import ORACLES, register
from tillbook.session import ORDERS_AS_OF
from tillbook.sources.adapters import Tables

# The market types of a match.
MARKETS = ("match_result", "over_under_2_5", "both_teams_score")


def settle_matches(matches: DataFrame, bets: DataFrame, legs: DataFrame, wallets: DataFrame, ledger_keys: DataFrame, as_of: str, n: int | None = 20) -> dict[str, DataFrame]:
    """Settle the first ``n`` finished matches by (finished_at, id).

    ``matches`` has finished_at; ``wallets`` has player_id, account, balance; ``ledger_keys`` the idempotency
    keys that the ledger already holds, so a win is credited once however often this runs. Returns bets
    (outcomes), matches and markets (settled ones with their time), ledger (new rows with balance_after) and wallets.
    """
    outcomes, wins, batch = settle(matches, bets, legs, n)
    now = ts_lit(as_of)
    done = batch.select(F.col("m_id").alias("id")).withColumn("_done", F.lit(True))
    state = (matches.join(done, "id", "left")
             .withColumn("status", F.when(F.col("_done"), "settled").otherwise(F.col("status")))
             .withColumn("settled_at", F.when(F.col("_done"), now)))
    market = F.when(F.col("status") == "settled", "settled").when(F.col("status") == "finished", "closed").otherwise("open")
    markets = state.select("id", F.explode(F.array(*map(F.lit, MARKETS))).alias("type"), market.alias("status"), "settled_at")
    rows = wins.select(F.col("reference_id").alias("id"), "player_id", "account", "type", "amount", now.alias("created_at"), "idempotency_key")
    ledger, new_wallets, _ = apply_ledger(wallets, rows, ledger_keys)
    return {"bets": outcomes, "matches": state.drop("_done"), "markets": markets, "ledger": ledger, "wallets": new_wallets}


def _settled(spark, d) -> dict[str, DataFrame]:
    """The fixture's matches, finished within the last 1,000 minutes; wallets start at 100."""
    t = Tables(spark, d)
    finished = ts_lit(ORDERS_AS_OF) - F.make_dt_interval(mins=(F.col("id") * 37 % 1000).cast("int"))
    matches = t.matches_v.withColumn("finished_at", F.when(F.col("status").isin("finished", "settled"), finished))
    wallets = t.players_v.select(F.col("id").alias("player_id"), F.lit("cash").alias("account"), F.lit(100).cast("decimal(14,2)").alias("balance"))
    keys = spark.createDataFrame([], "idempotency_key string")
    return settle_matches(matches, t.bets_v, t.legs_v, wallets, keys, ORDERS_AS_OF)


_BATCH_SQL = """finished AS (
  SELECT id, TIMESTAMP '2001-08-02 00:00:00' - to_minutes(CAST(id * 37 % 1000 AS BIGINT)) AS finished_at FROM matches_v WHERE status = 'finished'),
batch AS (SELECT id AS m_id FROM finished ORDER BY finished_at, id LIMIT 20)"""


def _bets_sql() -> str:
    """The registered settlement's oracle with the batch taken by finish."""
    sql = ORACLES["settlement"]
    a, b = sql.index("batch AS ("), sql.index("lr AS (")
    return sql[:a] + _BATCH_SQL + ",\n" + sql[b:]


@register("settlement_by_finish", oracle=_bets_sql())
def q_settlement_by_finish(spark, d):
    return _settled(spark, d)["bets"]


@register("settlement_markets", adapters=("matches_v",), oracle="WITH " + _BATCH_SQL + """
SELECT m.id, k.type, CASE WHEN m_id IS NOT NULL OR m.status = 'settled' THEN 'settled' WHEN m.status = 'finished' THEN 'closed' ELSE 'open' END AS status,
       CASE WHEN m_id IS NOT NULL THEN TIMESTAMP '2001-08-02 00:00:00' END AS settled_at
FROM matches_v m LEFT JOIN batch ON m_id = m.id, (SELECT unnest(['match_result', 'over_under_2_5', 'both_teams_score']) AS type) k""")
def q_settlement_markets(spark, d):
    """The three markets of every match after the settlement."""
    return _settled(spark, d)["markets"]


@register("settlement_ledger", oracle=f"""
SELECT player_id, 'cash' AS account, bet_id AS id, 'win' AS type, payout AS amount,
       CAST(100 + sum(payout) OVER (PARTITION BY player_id ORDER BY bet_id) AS DECIMAL(14,2)) AS balance_after
FROM ({_bets_sql()}) WHERE status = 'won'""")
def q_settlement_ledger(spark, d):
    """M06 through M16: the winners' ledger rows with the balance after each."""
    return _settled(spark, d)["ledger"].select("player_id", "account", "id", "type", "amount", "balance_after")
