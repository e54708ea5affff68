"""Join and window queries over the adapters (J03-J16, W03-W09, U01-U03, F-families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillbook.functions import changed, trunc_ts
from tillbook.operators.joins import anti_join, asof_join, first_per_key, not_in, period_join
from tillbook.operators.windows import rolling_sum_segmented, running_sum, segment_bucket, to_periods, transitions
from tillbook.plans.build import build_price_periods
from tillbook.plans.registry import register
from tillbook.session import ORDERS_AS_OF, checkpoint_dir
from tillbook.sources.adapters import Tables


def with_teams(matches, teams, team_id: str = "n_nationkey", team_name: str = "n_name"):
    """The same dimension twice, home and away, as two aliased joins."""
    h = teams.select(F.col(team_id).alias("h_id"), F.col(team_name).alias("home_team"))
    a = teams.select(F.col(team_id).alias("a_id"), F.col(team_name).alias("away_team"))
    return (matches.join(h, F.col("home_team_id") == F.col("h_id"))
            .join(a, F.col("away_team_id") == F.col("a_id")).drop("h_id", "a_id"))


def category_path(nodes):
    """Full path of every node of a tree (id, parent_id, name) by repeated self-joins.

    Each level is one join, written to the checkpoint folder; the loop ends when no path has a
    parent left to prepend. A parent cycle raises an error.
    """
    checkpoint_dir(nodes.sparkSession)
    longest = nodes.count()
    cur = nodes.select("id", F.col("parent_id").alias("_up"), F.col("name").alias("path"),
                       F.lit(1).alias("depth"))
    parents = nodes.select(F.col("id").alias("_pid"), F.col("parent_id").alias("_pparent"),
                           F.col("name").alias("_pname"))
    rounds = 0
    while not cur.filter(F.col("_up").isNotNull()).isEmpty():
        rounds += 1
        if rounds > longest:
            raise ValueError("the parents form a cycle")
        cur = (cur.join(parents, F.col("_up") == F.col("_pid"), "left")
               .select("id", F.col("_pparent").alias("_up"),
                       F.when(F.col("_pid").isNull(), F.col("path"))
                       .otherwise(F.concat_ws(" > ", F.col("_pname"), F.col("path"))).alias("path"),
                       (F.col("depth") + F.col("_pid").isNotNull().cast("int")).alias("depth")).checkpoint())
    return cur.drop("_up")


def _matches_with_team_ids(t: Tables):
    m = t.matches_v
    return m.select("id", "competition_id", "status", (F.col("id") % 25).cast("int").alias("home_team_id"),
                    ((F.col("id") + 1 + F.col("id") % 24) % 25).cast("int").alias("away_team_id"))


@register("match_teams", adapters=("matches_v",), oracle="""
SELECT m.id, m.competition_id, m.status, CAST(m.id % 25 AS INT) AS home_team_id,
       CAST((m.id + 1 + m.id % 24) % 25 AS INT) AS away_team_id, h.n_name AS home_team, a.n_name AS away_team
FROM matches_v m JOIN nation h ON h.n_nationkey = m.id % 25 JOIN nation a ON a.n_nationkey = (m.id + 1 + m.id % 24) % 25""")
def q_match_teams(spark, d):
    t = Tables(spark, d)
    return with_teams(_matches_with_team_ids(t), t.nation)


@register("first_line_per_order", adapters=("order_items_v",), oracle="""
SELECT order_id, line, product_id, quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY line, product_id, quantity) AS rn FROM order_items_v)
WHERE rn = 1""")
def q_first_line_per_order(spark, d):
    items = Tables(spark, d).order_items_v
    return first_per_key(items, "order_id", ["line", "product_id", "quantity"], ["line", "product_id", "quantity"])


@register("price_at_order", adapters=("order_items_v", "orders_v", "products_v"), oracle="""
WITH periods AS (
  SELECT p.id AS product_id, CAST(round(p.price * (0.8 + 0.1 * k), 2) AS DECIMAL(10,2)) AS price,
         TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 1 YEAR + to_months(CAST((k - 1) * 4 AS INT)) AS valid_from,
         CASE WHEN k < 3 THEN TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 1 YEAR + to_months(CAST(k * 4 AS INT)) END AS valid_to
  FROM products_v p, range(1, 4) r(k))
SELECT oi.order_id, oi.line, oi.product_id, o.created_at, pp.price AS period_price,
       CAST(oi.quantity * pp.price AS DECIMAL(38,2)) AS revenue
FROM order_items_v oi JOIN orders_v o ON o.id = oi.order_id
JOIN periods pp ON pp.product_id = oi.product_id AND pp.valid_from <= o.created_at
                AND (pp.valid_to IS NULL OR o.created_at < pp.valid_to)""")
def q_price_at_order(spark, d):
    t = Tables(spark, d)
    lines = t.order_items_v.join(t.orders_v.select(F.col("id").alias("oid"), "created_at"),
                                 F.col("oid") == F.col("order_id"))
    periods = build_price_periods(t.products_v, ORDERS_AS_OF).withColumnRenamed("product_id", "pp_product_id")
    j = period_join(lines, periods, "product_id", "pp_product_id", "created_at")
    return j.select("order_id", "line", "product_id", "created_at", F.col("price").alias("period_price"),
                    (F.col("quantity") * F.col("price")).cast("decimal(38,2)").alias("revenue"))


def _bets_from_events(t: Tables):
    return (t.events.filter(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("bet_id"), F.col("user_id").alias("selection_id"),
                    F.col("ts").alias("placed_at")))


@register("odds_at_placement", adapters=("odds_feed_v",), oracle="""
WITH bets AS (SELECT event_id AS bet_id, user_id AS selection_id, ts AS placed_at FROM events WHERE event_type = 'purchase')
SELECT b.bet_id, b.selection_id, b.placed_at,
       (SELECT f.odds FROM odds_feed_v f WHERE f.selection_id = b.selection_id AND f.changed_at <= b.placed_at
        ORDER BY f.changed_at DESC, f.id DESC LIMIT 1) AS odds
FROM bets b""")
def q_odds_at_placement(spark, d):
    t = Tables(spark, d)
    return asof_join(_bets_from_events(t), t.odds_feed_v, ["selection_id"], "placed_at", "changed_at", ["odds"],
                     right_order=["id"])


@register("region_nation_path", oracle="""
SELECT 'n' || CAST(n_nationkey AS VARCHAR) AS id, r_name || ' > ' || n_name AS path, 2 AS depth
FROM nation JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT 'r' || CAST(r_regionkey AS VARCHAR), r_name, 1 FROM region""")
def q_region_nation_path(spark, d):
    t = Tables(spark, d)
    nodes = (t.region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id"),
                             F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("name"))
             .unionByName(t.nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("id"),
                                          F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent_id"),
                                          F.col("n_name").alias("name"))))
    return category_path(nodes)


@register("products_never_ordered", adapters=("products_v", "order_items_v"), oracle="""
SELECT id, sku FROM products_v p WHERE NOT EXISTS (SELECT 1 FROM order_items_v oi WHERE oi.product_id = p.id)""")
def q_products_never_ordered(spark, d):
    t = Tables(spark, d)
    return anti_join(t.products_v.select("id", "sku"), t.order_items_v.select(F.col("product_id").alias("id")), ["id"])


@register("customers_without_cancellations", adapters=("customers_v", "orders_v"), oracle="""
SELECT status, count(*) AS customers FROM customers_v
WHERE id NOT IN (SELECT customer_id FROM orders_v WHERE status = 'cancelled') GROUP BY 1""")
def q_customers_without_cancellations(spark, d):
    t = Tables(spark, d)
    c = not_in(t.customers_v, "id", t.orders_v.filter(F.col("status") == "cancelled"), "customer_id")
    return c.groupBy("status").agg(F.count(F.lit(1)).alias("customers"))


@register("running_balance", adapters=("money_events_v",), oracle="""
SELECT id, player_id, account, amount,
       CAST(sum(amount) OVER (PARTITION BY player_id, account ORDER BY created_at, id ROWS UNBOUNDED PRECEDING)
            AS DECIMAL(38,2)) AS balance_after
FROM money_events_v""")
def q_running_balance(spark, d):
    m = Tables(spark, d).money_events_v
    r = running_sum(m, ["player_id", "account"], ["created_at", "id"], "amount", "balance_after", segment_bucket("created_at"))
    return r.select("id", "player_id", "account", "amount", F.col("balance_after").cast("decimal(38,2)"))


@register("odds_periods", adapters=("odds_feed_v",), oracle="""
SELECT id, selection_id, odds, changed_at AS valid_from,
       lead(changed_at) OVER (PARTITION BY selection_id ORDER BY changed_at, id) AS valid_to
FROM odds_feed_v""")
def q_odds_periods(spark, d):
    f = Tables(spark, d).odds_feed_v
    p = to_periods(f, ["selection_id"], "changed_at", ["changed_at", "id"], segment_bucket("changed_at"))
    return p.select("id", "selection_id", "odds", F.col("changed_at").alias("valid_from"), "valid_to")


@register("status_transitions", oracle="""
SELECT user_id, event_id, ts, from_status, event_type AS to_status FROM (
  SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_status FROM events)
WHERE from_status IS DISTINCT FROM event_type""")
def q_status_transitions(spark, d):
    e = Tables(spark, d).events
    t = transitions(e.select("user_id", "event_id", "ts", "event_type"), ["user_id"], ["ts", "event_id"],
                    "event_type", segment_bucket("ts"))
    return t.select("user_id", "event_id", "ts", F.col("from_event_type").alias("from_status"),
                    F.col("event_type").alias("to_status"))


@register("rolling_deposits_24h", adapters=("money_events_v",), oracle="""
SELECT id, player_id, created_at, amount,
       CAST(sum(amount) OVER (PARTITION BY player_id ORDER BY created_at
                         RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS DECIMAL(38,2)) AS deposits_24h
FROM money_events_v WHERE type = 'deposit'""")
def q_rolling_deposits_24h(spark, d):
    m = Tables(spark, d).money_events_v.filter(F.col("type") == "deposit").select("id", "player_id", "created_at",
                                                                                "amount")
    r = rolling_sum_segmented(m, ["player_id"], "created_at", "amount", 24 * 3600, "deposits_24h")
    return r.withColumn("deposits_24h", F.col("deposits_24h").cast("decimal(38,2)"))


@register("ledger_union", adapters=("money_events_v", "bets_v"), oracle="""
SELECT player_id, 'stake' AS type, -stake AS amount, placed_at AS created_at FROM bets_v
UNION ALL SELECT player_id, type, amount, created_at FROM money_events_v WHERE type IN ('deposit', 'withdrawal')
UNION ALL SELECT * FROM (VALUES (CAST(-1 AS BIGINT), 'opening', CAST(0 AS DECIMAL(14,2)),
                                 TIMESTAMP '1990-01-01 00:00:00')) v(player_id, type, amount, created_at)""")
def q_ledger_union(spark, d):
    """U01 + U03: UNION ALL of ledger sources plus a literal row list."""
    t = Tables(spark, d)
    stakes = t.bets_v.select("player_id", F.lit("stake").alias("type"), (-F.col("stake")).cast("decimal(14,2)")
                             .alias("amount"), F.col("placed_at").alias("created_at"))
    money = t.money_events_v.filter(F.col("type").isin("deposit", "withdrawal")).select(
        "player_id", "type", "amount", "created_at")
    lit_rows = spark.createDataFrame([(-1, "opening", 0, "1990-01-01 00:00:00")],
                                     "player_id bigint, type string, amount int, created_at string").select(
        "player_id", "type", F.col("amount").cast("decimal(14,2)").alias("amount"),
        F.col("created_at").cast("timestamp_ntz").alias("created_at"))
    return stakes.unionByName(money).unionByName(lit_rows)


@register("scalar_functions", adapters=("orders_v",), oracle="""
SELECT id, 'INV-' || strftime(created_at, '%Y') || '-' || lpad(CAST(id AS VARCHAR), 9, '0') AS invoice_number,
       date_trunc('week', created_at) AS week, CAST(dayofweek(created_at) + 6 AS INT) % 7 AS weekday,
       md5(CAST(id AS VARCHAR)) AS provider_ref, lower(left(status, 3)) AS status3,
       CASE WHEN id % 10 = 0 THEN NULL ELSE nullif(status, 'paid') END AS status_or_null,
       ['card', 'card', 'paypal', 'bank_transfer'][1 + id % 4] AS method,
       CAST(round(total_amount / 3, 2) AS DECIMAL(14,2)) AS third_half_up,
       CAST(round_even(total_amount / 3, 2) AS DECIMAL(14,2)) AS third_half_even,
       CAST(round(total_amount) AS BIGINT) AS rounded_signed,
       greatest(CAST(1.01 AS DOUBLE), round(1.0 / (1.06 * (0.15 + 0.6 * ((id * 7919) % 1000) / 1000.0)), 2)) AS home_odds
FROM orders_v""")
def q_scalar_functions(spark, d):
    """F01-F11 in one projection: string build, date truncation, weekday (Monday = 0), md5, conditional,
    array pick, half-up vs half-even rounding, MySQL SIGNED cast, implied odds."""
    from tillbook.functions import implied_odds, money, pick, round_half_up, signed, week_start  # noqa: F401

    o = Tables(spark, d).orders_v
    third = F.col("total_amount") / 3
    return o.select(
        "id",
        F.concat(F.lit("INV-"), F.date_format("created_at", "yyyy"), F.lit("-"),
                 F.lpad(F.col("id").cast("string"), 9, "0")).alias("invoice_number"),
        trunc_ts("week", "created_at").alias("week"),
        F.weekday("created_at").alias("weekday"),
        F.md5(F.col("id").cast("string")).alias("provider_ref"),
        F.lower(F.left("status", F.lit(3))).alias("status3"),
        F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.nullif("status", F.lit("paid"))).alias("status_or_null"),
        pick("id", ["card", "card", "paypal", "bank_transfer"]).alias("method"),
        round_half_up(third, 2).cast("decimal(14,2)").alias("third_half_up"),
        money(third, 2).cast("decimal(14,2)").alias("third_half_even"),
        signed("total_amount").alias("rounded_signed"),
        F.element_at(implied_odds("id"), 1).cast("double").alias("home_odds"),
    )


@register("changed_status", adapters=("orders_v",), oracle="""
SELECT count(*) FILTER (WHERE a IS DISTINCT FROM b) AS changed, count(*) AS total FROM (
  SELECT CASE WHEN id % 7 = 0 THEN NULL ELSE status END AS a, CASE WHEN id % 11 = 0 THEN NULL ELSE status END AS b
  FROM orders_v)""")
def q_changed_status(spark, d):
    """Null-safe change predicate (IS DISTINCT FROM)."""
    o = Tables(spark, d).orders_v.select(
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("status")).alias("a"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("status")).alias("b"))
    return o.agg(F.count_if(changed("a", "b")).alias("changed"), F.count(F.lit(1)).alias("total"))
