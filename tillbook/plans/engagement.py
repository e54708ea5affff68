"""Wishlists and reviews (B27), the whole product page (P01) with attributes, reviews and free stock (A18), the stock
difference (A08), and the pages with their details: bets with legs, live matches with teams (M22)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import pick, skewed_key, skewed_key_sql, ts_lit, uniform, uniform_sql
from tillbook.operators.windows import last_n
from tillbook.plans.book_jobs import _SEL_SQL, bet_history, build_selections
from tillbook.plans.registry import register
from tillbook.plans.relations import with_teams
from tillbook.plans.shop import free_stock, stock_recount
from tillbook.plans.shop_build import ATTRIBUTES, build_inventory, insert_ignore, product_attributes
from tillbook.plans.shop_jobs import inventory_from_ledger
from tillbook.plans.sportsbook import _BETS, _LEG_RESULTS_SQL, _bets_final, leg_results
from tillbook.sources.adapters import Tables

AS_OF = "2024-01-31 00:00:00"
# The ratings (weighted by repetition) and titles that reviews are drawn from.
RATINGS = (1, 2, 3, 4, 4, 5, 5, 5)
TITLES = ("Great", "Good value", "Not bad", "Disappointing", "Excellent", "As described", "Would buy again", "Broke quickly")


# ---- B27 ------------------------------------------------------------------------------------------------

def _bounds(df: DataFrame):
    """Least id and number of rows, as scalar subqueries."""
    b = df.agg(F.min("id").alias("lo"), F.count(F.lit(1)).alias("n"))
    return b.select("lo").scalar(), b.select("n").scalar()


def _ago(u, days: int):
    """A time up to ``days`` before AS_OF, in whole seconds."""
    secs = F.floor(u * float(days * 86_400)).cast("bigint")
    return (F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(secs=secs.cast("decimal(18,6)"))).cast("timestamp_ntz")


def build_wishlists(keys: DataFrame, customers: DataFrame, products: DataFrame, seed: int = 42) -> DataFrame:
    """A wish per key ``g``: any customer, products skewed to the small ids (B03), within a year; a pair drawn
    again is left out, the first draw winning (B07)."""
    (c_lo, c_n), (p_lo, p_n) = _bounds(customers), _bounds(products)
    g = F.col("g")
    rows = keys.select(g, (c_lo + F.floor(uniform(seed, 60, g) * c_n)).cast("bigint").alias("customer_id"),
                       skewed_key(uniform(seed, 61, g), p_lo, p_n, 2.0).alias("product_id"), _ago(uniform(seed, 62, g), 365).alias("added_at"))
    return insert_ignore(rows.filter(F.lit(False)), rows, ["customer_id", "product_id"], ["g"]).drop("g")


def build_reviews(keys: DataFrame, customers: DataFrame, products: DataFrame, seed: int = 42) -> DataFrame:
    """A review per key ``g``: skewed products, weighted ratings, within two years."""
    (c_lo, c_n), (p_lo, p_n) = _bounds(customers), _bounds(products)
    g = F.col("g")
    return keys.select(
        g.alias("id"), skewed_key(uniform(seed, 63, g), p_lo, p_n, 2.0).alias("product_id"),
        (c_lo + F.floor(uniform(seed, 64, g) * c_n)).cast("bigint").alias("customer_id"),
        pick(F.floor(uniform(seed, 65, g) * len(RATINGS)), RATINGS).cast("int").alias("rating"),
        pick(F.floor(uniform(seed, 66, g) * len(TITLES)), TITLES).alias("title"), _ago(uniform(seed, 67, g), 730).alias("created_at"))


def _u(draw: int) -> str:
    return uniform_sql(42, draw, "o_orderkey")


def _ago_sql(draw: int, days: int) -> str:
    return f"TIMESTAMP '{AS_OF}' - to_seconds(CAST(floor({_u(draw)} * {float(days * 86_400)}) AS BIGINT))"


_DRAWS_SQL = f"""cb AS (SELECT min(id) AS lo, count(*) AS n FROM customers_v), pb AS (SELECT min(id) AS lo, count(*) AS n FROM products_v),
reviews AS (SELECT o_orderkey AS id, {skewed_key_sql(_u(63), "pb.lo", "pb.n", 2.0)} AS product_id,
                   CAST(cb.lo + floor({_u(64)} * cb.n) AS BIGINT) AS customer_id,
                   {list(RATINGS)!r}[1 + CAST(floor({_u(65)} * {len(RATINGS)}) AS INT)] AS rating,
                   {list(TITLES)!r}[1 + CAST(floor({_u(66)} * {len(TITLES)}) AS INT)] AS title, {_ago_sql(67, 730)} AS created_at
            FROM orders, cb, pb)"""


def _keys(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("g"))


@register("wishlists_build", adapters=("customers_v", "products_v"), oracle=f"""
WITH {_DRAWS_SQL},
w AS (SELECT o_orderkey AS g, CAST(cb.lo + floor({_u(60)} * cb.n) AS BIGINT) AS customer_id,
             {skewed_key_sql(_u(61), "pb.lo", "pb.n", 2.0)} AS product_id, {_ago_sql(62, 365)} AS added_at FROM orders, cb, pb)
SELECT customer_id, product_id, arg_min(added_at, g) AS added_at FROM w GROUP BY ALL""")
def q_wishlists_build(spark, d):
    t = Tables(spark, d)
    return build_wishlists(_keys(t), t.customers_v, t.products_v)


@register("reviews_build", adapters=("customers_v", "products_v"), oracle=f"WITH {_DRAWS_SQL}\nSELECT * FROM reviews")
def q_reviews_build(spark, d):
    t = Tables(spark, d)
    return build_reviews(_keys(t), t.customers_v, t.products_v)


# ---- P01 --------------------------------------------------------------------------------------------------

def product_details(products: DataFrame, attributes: DataFrame, reviews: DataFrame, inventory: DataFrame, n: int = 5) -> DataFrame:
    """P01 over every product: category and brand, attributes by name, the last ``n`` reviews, and the free stock
    (quantity less reserved, A18).

    The last reviews of a product are cut by a partial limit before the shuffle, so a product with a third
    of all reviews sends at most ``n`` from each task; attributes are a fixed few.
    """
    attrs = attributes.groupBy("product_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("attributes"))
    last = last_n(reviews, ["product_id"], [F.col("created_at").desc(), F.col("id").desc()], n)
    last = last.groupBy("product_id").agg(F.array_sort(F.collect_list(F.struct("rn", "rating", "title", "created_at"))).alias("reviews"))
    page = products.select(F.col("id").alias("product_id"), "sku", "name", "price", F.col("parent_category").alias("category_name"),
                           F.col("category").alias("brand_name"))
    for part in (attrs, last, free_stock(inventory)):
        page = page.join(part, "product_id", "left")
    return page.withColumn("free_stock", F.coalesce("free_stock", F.lit(0)))


@register("product_details", adapters=("products_v", "customers_v"), oracle=f"""
WITH {_DRAWS_SQL},
last AS (SELECT product_id, list(CAST(rating AS VARCHAR) || ' ' || title ORDER BY created_at DESC, id DESC)[:5] AS latest, count(*) AS n
         FROM reviews GROUP BY 1),
stock AS (SELECT p.id, CASE WHEN {uniform_sql(42, 30, "p.id", "w")} < 0.02e0 THEN 0
                            ELSE 50 + CAST(floor({uniform_sql(42, 31, "p.id", "w")} * 950) AS INT) END AS q
          FROM products_v p, range(1, 6) r(w))
SELECT p.id AS product_id, p.sku, p.name, p.price, p.parent_category AS category_name, p.category AS brand_name,
       'color-' || CAST(p.id % 7 AS VARCHAR) AS color, 'material-' || CAST(p.id % 7 AS VARCHAR) AS material,
       'size-' || CAST(p.id % 7 AS VARCHAR) AS size, 'warranty-' || CAST(p.id % 7 AS VARCHAR) AS warranty, l.latest AS latest_reviews,
       (SELECT CAST(sum(q - q % 7) AS BIGINT) FROM stock s WHERE s.id = p.id) AS free_stock
FROM products_v p LEFT JOIN last l ON l.product_id = p.id""")
def q_product_details(spark, d):
    t = Tables(spark, d)
    inventory = build_inventory(t.products_v)[0].withColumn("reserved", F.col("quantity") % 7)
    page = product_details(t.products_v, product_attributes(t.products_v), build_reviews(_keys(t), t.customers_v, t.products_v), inventory)
    shown = F.transform("reviews", lambda r: F.concat(r.rating.cast("string"), F.lit(" "), r.title))
    return page.select("product_id", "sku", "name", "price", "category_name", "brand_name",
                       *[F.element_at("attributes", F.lit(a)).alias(a) for a in sorted(ATTRIBUTES)], shown.alias("latest_reviews"), "free_stock")


@register("free_stock", adapters=("products_v",), oracle=f"""
WITH s AS (SELECT p.id, CASE WHEN {uniform_sql(42, 30, "p.id", "w")} < 0.02e0 THEN 0
                             ELSE 50 + CAST(floor({uniform_sql(42, 31, "p.id", "w")} * 950) AS INT) END AS q
           FROM products_v p, range(1, 6) r(w))
SELECT id AS product_id, CAST(sum(q) - sum(q % 7) AS BIGINT) AS free_stock FROM s GROUP BY 1""")
def q_free_stock(spark, d):
    """Free stock of every product, with reserved units."""
    inventory = build_inventory(Tables(spark, d).products_v)[0]
    return free_stock(inventory.withColumn("reserved", F.col("quantity") % 7))


@register("stock_difference", adapters=("stock_movements_v",), oracle="""
WITH l AS (SELECT warehouse_id, product_id, sum(quantity) AS q FROM stock_movements_v GROUP BY ALL),
s AS (SELECT * FROM (SELECT warehouse_id, product_id, q - CAST(product_id % 3 = 0 AS INT) AS q FROM l WHERE product_id % 50 <> 0
                     UNION ALL SELECT 9, product_id, 7 FROM l WHERE warehouse_id = 1 AND product_id % 40 = 0))
SELECT coalesce(l.warehouse_id, s.warehouse_id) AS warehouse_id, coalesce(l.product_id, s.product_id) AS product_id,
       CAST(l.q AS BIGINT) AS ledger_quantity, CAST(s.q AS BIGINT) AS snapshot_quantity, CAST(ifnull(s.q, 0) - ifnull(l.q, 0) AS BIGINT) AS difference
FROM l FULL JOIN s ON s.warehouse_id = l.warehouse_id AND s.product_id = l.product_id""")
def q_stock_difference(spark, d):
    """The recount against a snapshot that lacks some rows, has some too many, and is one unit short for others."""
    moves = Tables(spark, d).stock_movements_v
    own = inventory_from_ledger(moves)
    short = own.filter(F.col("product_id") % 50 != 0).select(
        "warehouse_id", "product_id", (F.col("quantity") - (F.col("product_id") % 3 == 0).cast("int")).alias("quantity"))
    extra = own.filter((F.col("warehouse_id") == 1) & (F.col("product_id") % 40 == 0)).select(
        F.lit(9).alias("warehouse_id"), "product_id", F.lit(7).alias("quantity"))
    return stock_recount(moves, short.unionByName(extra))


# ---- M22 pages with their details ---------------------------------------------------------------------------

def bet_history_legs(bets: DataFrame, legs: DataFrame, matches: DataFrame, n: int = 20) -> DataFrame:
    """Each player's last ``n`` bets with their legs: odds taken, selection, result and the match's score."""
    last = bet_history(bets, n).withColumnRenamed("id", "bet_id")
    shown = leg_results(legs, matches).select("bet_id", "event_id", "odds", "selection", "result")
    score = matches.select(F.col("id").alias("event_id"), "home_score", "away_score")
    return last.join(shown, "bet_id").join(score, "event_id")


@register("bet_history_legs", adapters=_BETS, oracle=f"""WITH {_LEG_RESULTS_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY placed_at DESC, id DESC) AS rn FROM bets_final QUALIFY rn <= 20)
SELECT l.event_id, r.id AS bet_id, r.player_id, r.type, r.stake, r.total_odds, r.status, r.payout, r.placed_at, r.rn,
       l.odds, l.selection, l.result, m.home_score, m.away_score
FROM r JOIN leg_results l ON l.bet_id = r.id JOIN matches_v m ON m.id = l.event_id""")
def q_bet_history_legs(spark, d):
    t = Tables(spark, d)
    return bet_history_legs(_bets_final(t), t.legs_v, t.matches_v)


def live_details(matches: DataFrame, teams: DataFrame, n: int = 90) -> DataFrame:
    """The live page: kick-off, score, team names, the state of the match-result market and its odds; the first
    ``n`` rows by kick-off, match and selection. ``matches`` has team ids, kicked_off_at and market_status."""
    live = with_teams(matches.filter(F.col("status") == "live"), teams)
    sel = build_selections(live).filter(F.col("market") == "match_result").select("event_id", "selection_id", "name", "odds")
    return (live.join(sel, F.col("event_id") == F.col("id"))
            .select("event_id", "kicked_off_at", "home_score", "away_score", "home_team", "away_team", "market_status", "selection_id", "name", "odds")
            .orderBy("kicked_off_at", "event_id", "selection_id").limit(n))


@register("live_details", adapters=("matches_v",), oracle=_SEL_SQL + f""",
live AS (SELECT *, TIMESTAMP '{AS_OF}' - to_seconds(CAST(id * 17 % 900 AS BIGINT)) AS kicked_off_at FROM matches_v WHERE status = 'live')
SELECT m.id AS event_id, kicked_off_at, home_score, away_score, h.n_name AS home_team, a.n_name AS away_team,
       CASE WHEN m.id % 3 = 0 THEN 'suspended' ELSE 'open' END AS market_status, s.selection_id, s.name, s.odds
FROM live m JOIN nation h ON h.n_nationkey = m.id % 25 JOIN nation a ON a.n_nationkey = (m.id + 1 + m.id % 24) % 25
JOIN sel s ON s.event_id = m.id AND s.market = 'match_result'
ORDER BY kicked_off_at, m.id, s.selection_id LIMIT 90""")
def q_live_details(spark, d):
    t = Tables(spark, d)
    matches = t.matches_v.withColumns({
        "home_team_id": (F.col("id") % 25).cast("int"), "away_team_id": ((F.col("id") + 1 + F.col("id") % 24) % 25).cast("int"),
        "kicked_off_at": ts_lit(AS_OF) - F.make_dt_interval(secs=(F.col("id") * 17 % 900).cast("decimal(18,6)")),
        "market_status": F.when(F.col("id") % 3 == 0, "suspended").otherwise("open")})
    return live_details(matches, t.nation)
