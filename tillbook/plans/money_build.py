"""Rows of generated money: refunds (B15), the times of settled bets (B22), and every ledger row with its balance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import stable_uuid, ts_lit
from tillbook.operators.admission import stored
from tillbook.operators.windows import running_sum, segment_bucket
from tillbook.plans import build as B
from tillbook.plans.registry import register
from tillbook.plans.sportsbook import _BETS, _LEG_RESULTS_SQL, _bets_final, match_starts
from tillbook.session import ORDERS_AS_OF
from tillbook.sources.adapters import Tables

AMOUNT = "decimal(14,2)"


def derive_refunds(payments: DataFrame) -> DataFrame:
    """A refund of every refunded payment with an amount, its reason by the payment's id modulo the reasons."""
    reason = F.element_at(F.array(*map(F.lit, B.REFUND_REASONS)), (1 + F.col("id") % len(B.REFUND_REASONS)).cast("int"))
    return payments.filter((F.col("status") == "refunded") & (F.col("amount") > 0)).select(
        F.col("id").alias("payment_id"), "amount", reason.alias("reason"), F.col("updated_at").alias("created_at"))


def timed_bets(bets: DataFrame, legs: DataFrame, matches: DataFrame) -> DataFrame:
    """Bets placed up to two days before their first match starts, settled five minutes after the last one ends.

    ``matches`` has starts_at and finished_at. An open bet has no settled_at.
    """
    m = matches.select(F.col("id").alias("event_id"), "starts_at", "finished_at")
    span = legs.select("bet_id", "event_id").join(m, "event_id").groupBy(F.col("bet_id").alias("id")).agg(
        F.min("starts_at").alias("_first"), F.max("finished_at").alias("_last"))
    early = F.make_dt_interval(mins=(1 + F.col("id") * 7919 % 2880).cast("int"))
    settled = F.when(F.col("status") != "open", F.col("_last") + F.make_dt_interval(mins=F.lit(5)))
    return bets.drop("placed_at").join(span, "id").withColumns(
        {"placed_at": F.col("_first") - early, "settled_at": settled}).drop("_first", "_last")


def ledger_rows(players: DataFrame, bets: DataFrame, as_of: str) -> DataFrame:
    """Deposits, stakes, wins and withdrawals as ledger rows, with the running balance of each player.

    A player's first deposit, a day after sign-up (or before the first bet, if that is sooner), covers all stakes plus
    50 to 500; whoever has more than 300 left withdraws half an hour before ``as_of``. ``players`` has created_at;
    ``bets`` has placed_at and settled_at; they are read four times, so they are written once.
    """
    bets, _ = stored(bets)
    totals = B.build_ledger(players, bets)
    first = bets.groupBy("player_id").agg(F.min("placed_at").alias("_bet"))
    day, hour = F.make_dt_interval(days=F.lit(1)), F.make_dt_interval(hours=F.lit(1))
    p = (totals.join(players.select(F.col("id").alias("player_id"), "created_at"), "player_id").join(first, "player_id", "left")
         .withColumn("_paid", F.least(F.col("created_at") + day, F.col("_bet") - hour)))

    def rows(df: DataFrame, step: int, kind: str, amount, at, reference: str, ref_id: str) -> DataFrame:
        return df.select("player_id", F.lit(step).alias("step"), F.lit(kind).alias("type"), F.lit("cash").alias("account"),
                         amount.cast(AMOUNT).alias("amount"), F.lit(reference).alias("reference_type"), F.col(ref_id).alias("reference_id"),
                         at.alias("created_at"))

    won = bets.filter(F.col("status") == "won")
    ledger = rows(p, 0, "deposit", F.col("deposit"), F.col("_paid"), "payment", "player_id")
    ledger = ledger.unionByName(rows(bets, 1, "stake", -F.col("stake"), F.col("placed_at"), "bet", "id"))
    ledger = ledger.unionByName(rows(won, 2, "win", F.col("payout"), F.col("settled_at"), "bet", "id"))
    ledger = ledger.unionByName(rows(p.filter(F.col("withdrawal") > 0), 3, "withdrawal", -F.col("withdrawal"), ts_lit(as_of) - hour,
                                     "payment", "player_id"))
    run = running_sum(ledger, ["player_id", "account"], ["created_at", "step", "reference_id"], "amount", "balance_after",
                      segment_bucket("created_at"))
    return run.withColumn("balance_after", F.col("balance_after").cast(AMOUNT)).withColumn(
        "idempotency_key", stable_uuid("type", "reference_id")).drop("step")


def _matches(t: Tables) -> DataFrame:
    return match_starts(t.matches_v).withColumn("finished_at", F.col("starts_at") + F.make_dt_interval(hours=F.lit(2)))


def _timed(t: Tables) -> DataFrame:
    return timed_bets(_bets_final(t), t.legs_v, _matches(t))


def _players(t: Tables) -> DataFrame:
    born = ts_lit("2000-01-01 00:00:00") + F.make_dt_interval(days=(F.col("id") % 365).cast("int"))
    return t.players_v.withColumn("created_at", born)


_TIMED_SQL = f"""{_LEG_RESULTS_SQL},
starts AS (SELECT id AS event_id, TIMESTAMP '{ORDERS_AS_OF}' + to_days(CAST(2 - id * 13 % 62 AS INT)) + to_hours(CAST(id % 24 AS INT)) AS kick FROM matches_v),
span AS (SELECT bet_id, min(kick) AS first_at, max(kick) AS last_at FROM legs_v JOIN starts USING (event_id) GROUP BY 1),
timed AS (SELECT b.* EXCLUDE (placed_at), first_at - to_minutes(CAST(1 + b.id * 7919 % 2880 AS BIGINT)) AS placed_at,
                 CASE WHEN status <> 'open' THEN last_at + INTERVAL 125 MINUTE END AS settled_at
          FROM bets_final b JOIN span ON bet_id = b.id)"""


@register("refunds_build", adapters=("orders_v",), oracle=f"""
SELECT id AS payment_id, total_amount AS amount, {list(B.REFUND_REASONS)!r}[1 + id % {len(B.REFUND_REASONS)}] AS reason,
       created_at + INTERVAL 4 DAY AS created_at
FROM orders_v WHERE status = 'refunded' AND total_amount > 0""")
def q_refunds_build(spark, d):
    payments = B.derive_payments(B.with_updated_at(Tables(spark, d).orders_v)).withColumnRenamed("order_id", "id")
    return derive_refunds(payments)


@register("bets_timed", adapters=_BETS, oracle=f"WITH {_TIMED_SQL}\nSELECT * FROM timed")
def q_bets_timed(spark, d):
    return _timed(Tables(spark, d))


@register("ledger_rows", adapters=_BETS + ("players_v",), oracle=f"""WITH {_TIMED_SQL},
per AS (SELECT player_id, sum(stake) AS staked, sum(CASE WHEN status = 'won' THEN payout ELSE 0 END) AS won, min(placed_at) AS first_bet FROM timed GROUP BY 1),
d AS (SELECT id AS player_id, CAST(coalesce(staked, 0) + 50 + (id * 7919) % 451 AS DECIMAL(14,2)) AS deposit, coalesce(staked, 0) AS staked, coalesce(won, 0) AS won,
             least(TIMESTAMP '2000-01-02 00:00:00' + to_days(CAST(id % 365 AS INT)), first_bet - INTERVAL 1 HOUR) AS paid
      FROM players_v LEFT JOIN per ON per.player_id = id),
w AS (SELECT player_id, CAST(round((deposit - staked + won) * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(14,2)) AS half FROM d WHERE deposit - staked + won > 300),
r AS (SELECT player_id, 0 AS step, 'deposit' AS type, deposit AS amount, 'payment' AS reference_type, player_id AS reference_id, paid AS created_at FROM d
      UNION ALL SELECT player_id, 1, 'stake', -stake, 'bet', id, placed_at FROM timed
      UNION ALL SELECT player_id, 2, 'win', payout, 'bet', id, settled_at FROM timed WHERE status = 'won'
      UNION ALL SELECT player_id, 3, 'withdrawal', -half, 'payment', player_id, TIMESTAMP '{ORDERS_AS_OF}' - INTERVAL 1 HOUR FROM w),
k AS (SELECT *, md5(type || '|' || CAST(reference_id AS VARCHAR)) AS h FROM r)
SELECT player_id, type, 'cash' AS account, CAST(amount AS DECIMAL(14,2)) AS amount, reference_type, reference_id, created_at,
       CAST(sum(amount) OVER (PARTITION BY player_id ORDER BY created_at, step, reference_id) AS DECIMAL(14,2)) AS balance_after,
       substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12) AS idempotency_key
FROM k""")
def q_ledger_rows(spark, d):
    t = Tables(spark, d)
    return ledger_rows(_players(t), _timed(t), ORDERS_AS_OF)
