"""Driver-table adapters: derive the shop / sportsbook / telemetry shapes from the driver tables.

Each adapter exists twice: as a DataFrame function (what the library runs) and as SQL text
(``ADAPTER_SQL``) that the DuckDB oracle runs as a CTE.  The two are written independently,
so every oracle comparison also checks the adapter.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions import trunc_ts
from tillbook.session import configure
from tillbook.sources.tables import load_table


def _dec(c: Column, p: int, s: int) -> Column:
    return c.cast(f"decimal({p},{s})")


def products_v(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.lit("SKU-"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("parent_category"),
        F.col("p_brand").alias("category"),
        _dec(F.col("p_retailprice"), 10, 2).alias("price"),
        (F.col("p_partkey") % 50 != 0).alias("active"),
    )


def customers_v(customer: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    # nation is a fixed 25-row dimension: broadcasting it is bounded by definition.
    return customer.join(F.broadcast(nation), F.col("n_nationkey") == F.col("c_nationkey")).select(
        k.alias("id"),
        F.concat(F.lit("customer"), k.cast("string"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country_code"),
        F.when(k % 97 == 0, "closed").when(k % 53 == 0, "suspended").otherwise("active").alias("status"),
    )


def orders_v(orders: DataFrame) -> DataFrame:
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    status = (F.when(k % 33 == 0, "cancelled").when(k % 50 == 0, "refunded")
              .when(st == "F", "delivered")
              .when((st == "O") & (k % 3 == 0), "paid")
              .when(st == "O", "shipped").otherwise("pending"))
    return orders.select(
        k.alias("id"), F.col("o_custkey").alias("customer_id"), status.alias("status"),
        _dec(F.col("o_totalprice"), 12, 2).alias("total_amount"), F.col("o_orderdate").alias("created_at"),
    )


def order_items_v(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    return lineitem.join(part, F.col("p_partkey") == F.col("l_partkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
        _dec(F.col("p_retailprice"), 10, 2).alias("unit_price"),
    )


def shipments_v(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    # Both sides are keyed by the order: aggregate the lines first (partial aggregation
    # before the shuffle), then join one row per order.
    ship = lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped_at"),
                                              F.max("l_shipdate").alias("last_ship"))
    o = orders.filter(F.col("o_orderstatus") != "P")
    return o.join(ship, ship.l_orderkey == k).select(
        k.alias("id"), k.alias("order_id"), (1 + k % 5).cast("int").alias("warehouse_id"),
        (1 + k % 6).cast("int").alias("carrier_id"), F.col("o_orderdate").alias("created_at"),
        F.col("shipped_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("last_ship")).alias("delivered_at"),
    )


def stock_movements_v(lineitem: DataFrame) -> DataFrame:
    """A sale per line and an opening purchase per first line, from one scan of ``lineitem``
    (each line explodes into one or two movements instead of a second scan for the union)."""
    q = F.col("l_quantity").cast("int")
    sale = F.struct((-q).alias("quantity"), F.lit("sale").alias("reason"), F.col("l_orderkey").alias("order_id"))
    purchase = F.struct((q + 100).alias("quantity"), F.lit("purchase").alias("reason"),
                        F.lit(None).cast("bigint").alias("order_id"))
    moves = F.when(F.col("l_linenumber") == 1, F.array(sale, purchase)).otherwise(F.array(sale))
    return lineitem.select((1 + F.col("l_orderkey") % 5).cast("int").alias("warehouse_id"),
                           F.col("l_partkey").alias("product_id"), F.explode(moves).alias("m")).select(
        "warehouse_id", "product_id", "m.quantity", "m.reason", "m.order_id")


def players_v(customer: DataFrame, nation: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.join(F.broadcast(nation), F.col("n_nationkey") == F.col("c_nationkey")).select(
        k.alias("id"), F.concat(F.lit("player"), k.cast("string")).alias("username"),
        F.col("n_name").alias("country_code"),
        F.when(k % 101 == 0, "self_excluded").when(k % 97 == 0, "closed").when(k % 89 == 0, "suspended")
        .otherwise("active").alias("status"),
        F.when(k % 10 == 0, "pending").otherwise("verified").alias("kyc_status"),
        _dec(F.when(k % 200 == 0, 10000).when(k % 40 == 0, 2500).when(k % 10 == 0, 1000).otherwise(500), 12, 2)
        .alias("max_stake"),
        _dec(F.when(k % 7 == 0, 1000), 12, 2).alias("daily_deposit_limit"),
        _dec(F.when(k % 11 == 0, 300), 12, 2).alias("daily_loss_limit"),
    )


def matches_v(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("id"), (1 + k % 12).cast("int").alias("competition_id"),
        ((k * 7) % 6).cast("int").alias("home_score"), ((k * 11) % 5).cast("int").alias("away_score"),
        F.when(k % 10 == 0, "scheduled").when(k % 10 == 1, "live").when(k % 10 == 2, "finished")
        .otherwise("settled").alias("status"),
    )


def _bet_id(line: Column) -> Column:
    """An order's lines are legs of bets of at most four: lines 1-4, 5-8 and so on."""
    return F.col("l_orderkey") * 4 + F.floor((line - 1) / 4)


def legs_v(lineitem: DataFrame) -> DataFrame:
    g = (lineitem.groupBy(_bet_id(F.col("l_linenumber")).alias("bet_id"), F.col("l_linenumber"))
         .agg(F.min("l_partkey").alias("event_id"))
         .select("bet_id", "event_id", (1 + F.col("l_linenumber") % 7).cast("int").alias("outcome")))
    odds = _dec(F.lit(1.01).cast("decimal(3,2)") + _dec(F.col("event_id") % 400, 7, 3) / 100, 7, 3)
    return g.select("bet_id", "event_id", "outcome",
                    (F.col("event_id") * 7 + F.col("outcome")).alias("selection_id"), odds.alias("odds"))


def bets_v(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A bet per order, and a further one for every four lines beyond the fourth."""
    m = (F.col("o_orderkey") % 10).cast("int")
    stake = (F.when(m == 0, 2).when(m.isin(1, 2), 5).when(m == 6, 20).when(m == 7, 25).when(m == 8, 50)
             .when(m == 9, 100).otherwise(10))
    further = (lineitem.filter(F.col("l_linenumber") > 4)
               .select("l_orderkey", _bet_id(F.col("l_linenumber")).alias("id")).distinct())
    first = orders.withColumn("id", F.col("o_orderkey") * 4)
    bets = first.unionByName(orders.join(further, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey"))
    return bets.select("id", F.col("o_custkey").alias("player_id"), _dec(stake, 12, 2).alias("stake"),
                       F.col("o_orderdate").alias("placed_at"))


def requests_v(events: DataFrame) -> DataFrame:
    k = F.col("event_id")
    result = (F.when(k % 20 == 0, "lock_timeout").when(k % 33 == 0, "out_of_stock").when(k % 50 == 0, "deadlock")
              .otherwise("ok"))
    return events.select("event_id", "ts", F.col("event_type").alias("tx"), "user_id", result.alias("result"),
                         _dec(F.col("value"), 12, 2).alias("latency_ms"))


def checks_v(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", F.concat(F.lit("db"), (F.col("user_id") % 4).cast("string")).alias("target"),
                         (F.col("event_type") != "error").alias("ok"))


def money_events_v(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    typ = (F.when(et == "signup", "deposit").when(et == "purchase", "stake").when(et == "click", "win")
           .when(et == "view", "withdrawal").otherwise("bonus"))
    amount = _dec(F.col("value"), 14, 2)
    return events.select(
        F.col("event_id").alias("id"), F.col("ts").alias("created_at"), F.col("user_id").alias("player_id"),
        typ.alias("type"), F.when(et == "error", "bonus").otherwise("cash").alias("account"),
        F.when(et.isin("purchase", "view"), -amount).otherwise(amount).alias("amount"),
    )


def odds_feed_v(events: DataFrame) -> DataFrame:
    odds = _dec(F.lit(1.01).cast("decimal(3,2)") + _dec(F.col("event_id") % 900, 7, 3) / 100, 7, 3)
    return events.filter(F.col("event_type").isin("view", "click")).select(
        F.col("event_id").alias("id"), F.col("ts").alias("changed_at"), F.col("user_id").alias("selection_id"),
        odds.alias("odds"))


def session_samples_v(events: DataFrame) -> DataFrame:
    u = F.col("user_id")
    return (events.groupBy(trunc_ts("day", "ts").alias("sample"), u.alias("pid"), (u % 7).alias("blocking_user"),
                           F.when(u % 10 == 0, F.lit(None).cast("bigint")).otherwise(u - 1).alias("blocker_pid"))
            .agg(F.min("ts").alias("xact_start")))


class Tables:
    """Lazy access to the driver tables and their adapters for one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return load_table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
            return self.raw(name)
        raise AttributeError(name)

    @cached_property
    def products_v(self): return products_v(self.part)
    @cached_property
    def customers_v(self): return customers_v(self.customer, self.nation)
    @cached_property
    def orders_v(self): return orders_v(self.orders)
    @cached_property
    def order_items_v(self): return order_items_v(self.lineitem, self.part)
    @cached_property
    def shipments_v(self): return shipments_v(self.orders, self.lineitem)
    @cached_property
    def stock_movements_v(self): return stock_movements_v(self.lineitem)
    @cached_property
    def players_v(self): return players_v(self.customer, self.nation)
    @cached_property
    def matches_v(self): return matches_v(self.part)
    @cached_property
    def legs_v(self): return legs_v(self.lineitem)
    @cached_property
    def bets_v(self): return bets_v(self.orders, self.lineitem)
    @cached_property
    def requests_v(self): return requests_v(self.events)
    @cached_property
    def checks_v(self): return checks_v(self.events)
    @cached_property
    def money_events_v(self): return money_events_v(self.events)
    @cached_property
    def odds_feed_v(self): return odds_feed_v(self.events)
    @cached_property
    def session_samples_v(self): return session_samples_v(self.events)


# SQL text of the adapters, used only by the DuckDB oracle (FIXTURES.md §4).
ADAPTER_SQL: dict[str, str] = {
    "products_v": """SELECT p_partkey AS id, 'SKU-' || lpad(CAST(p_partkey AS STRING), 8, '0') AS sku, p_name AS name,
       p_type AS parent_category, p_brand AS category, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       (p_partkey % 50 <> 0) AS active
FROM part""",
    "customers_v": """SELECT c.c_custkey AS id, 'customer' || CAST(c.c_custkey AS STRING) || '@example.com' AS email, n.n_name AS country_code,
       CASE WHEN c.c_custkey % 97 = 0 THEN 'closed' WHEN c.c_custkey % 53 = 0 THEN 'suspended' ELSE 'active' END AS status
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "orders_v": """SELECT o_orderkey AS id, o_custkey AS customer_id,
       CASE WHEN o_orderkey % 33 = 0 THEN 'cancelled' WHEN o_orderkey % 50 = 0 THEN 'refunded'
            WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN 'paid'
            WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'pending' END AS status,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderdate AS created_at
FROM orders""",
    "order_items_v": """SELECT l.l_orderkey AS order_id, l.l_linenumber AS line, l.l_partkey AS product_id, CAST(l.l_quantity AS INT) AS quantity,
       CAST(p.p_retailprice AS DECIMAL(10,2)) AS unit_price
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
    "shipments_v": """SELECT o.o_orderkey AS id, o.o_orderkey AS order_id, CAST(1 + o.o_orderkey % 5 AS INT) AS warehouse_id,
       CAST(1 + o.o_orderkey % 6 AS INT) AS carrier_id, o.o_orderdate AS created_at, min(l.l_shipdate) AS shipped_at,
       CASE WHEN o.o_orderstatus = 'F' THEN max(l.l_shipdate) END AS delivered_at
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE o.o_orderstatus <> 'P'
GROUP BY o.o_orderkey, o.o_orderdate, o.o_orderstatus""",
    "stock_movements_v": """SELECT CAST(1 + l_orderkey % 5 AS INT) AS warehouse_id, l_partkey AS product_id, -CAST(l_quantity AS INT) AS quantity,
       'sale' AS reason, l_orderkey AS order_id
FROM lineitem
UNION ALL
SELECT CAST(1 + l_orderkey % 5 AS INT), l_partkey, CAST(l_quantity AS INT) + 100, 'purchase', CAST(NULL AS BIGINT)
FROM lineitem WHERE l_linenumber = 1""",
    "players_v": """SELECT c_custkey AS id, 'player' || CAST(c_custkey AS STRING) AS username, n_name AS country_code,
       CASE WHEN c_custkey % 101 = 0 THEN 'self_excluded' WHEN c_custkey % 97 = 0 THEN 'closed'
            WHEN c_custkey % 89 = 0 THEN 'suspended' ELSE 'active' END AS status,
       CASE WHEN c_custkey % 10 = 0 THEN 'pending' ELSE 'verified' END AS kyc_status,
       CAST(CASE WHEN c_custkey % 200 = 0 THEN 10000 WHEN c_custkey % 40 = 0 THEN 2500
                 WHEN c_custkey % 10 = 0 THEN 1000 ELSE 500 END AS DECIMAL(12,2)) AS max_stake,
       CAST(CASE WHEN c_custkey % 7 = 0 THEN 1000 END AS DECIMAL(12,2)) AS daily_deposit_limit,
       CAST(CASE WHEN c_custkey % 11 = 0 THEN 300 END AS DECIMAL(12,2)) AS daily_loss_limit
FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "matches_v": """SELECT p_partkey AS id, CAST(1 + p_partkey % 12 AS INT) AS competition_id,
       CAST((p_partkey * 7) % 6 AS INT) AS home_score, CAST((p_partkey * 11) % 5 AS INT) AS away_score,
       CASE WHEN p_partkey % 10 = 0 THEN 'scheduled' WHEN p_partkey % 10 = 1 THEN 'live'
            WHEN p_partkey % 10 = 2 THEN 'finished' ELSE 'settled' END AS status
FROM part""",
    "legs_v": """SELECT bet_id, event_id, outcome, event_id * 7 + outcome AS selection_id,
       CAST(1.01 + CAST(event_id % 400 AS DECIMAL(7,3)) / 100 AS DECIMAL(7,3)) AS odds
FROM (SELECT l_orderkey * 4 + (l_linenumber - 1) // 4 AS bet_id, min(l_partkey) AS event_id, CAST(1 + l_linenumber % 7 AS INT) AS outcome
      FROM lineitem GROUP BY l_orderkey, l_linenumber) g""",
    "bets_v": """SELECT o_orderkey * 4 + part_no AS id, o_custkey AS player_id,
       CAST(CASE CAST(o_orderkey % 10 AS INT) WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN 5 WHEN 6 THEN 20 WHEN 7 THEN 25
                 WHEN 8 THEN 50 WHEN 9 THEN 100 ELSE 10 END AS DECIMAL(12,2)) AS stake,
       o_orderdate AS placed_at
FROM (SELECT o_orderkey AS k, 0 AS part_no FROM orders
      UNION SELECT l_orderkey, (l_linenumber - 1) // 4 FROM lineitem WHERE l_linenumber > 4) JOIN orders ON o_orderkey = k""",
    "requests_v": """SELECT event_id, ts, event_type AS tx, user_id,
       CASE WHEN event_id % 20 = 0 THEN 'lock_timeout' WHEN event_id % 33 = 0 THEN 'out_of_stock'
            WHEN event_id % 50 = 0 THEN 'deadlock' ELSE 'ok' END AS result,
       CAST(value AS DECIMAL(12,2)) AS latency_ms
FROM events""",
    "checks_v": """SELECT event_id, ts, 'db' || CAST(user_id % 4 AS STRING) AS target, (event_type <> 'error') AS ok
FROM events""",
    "money_events_v": """SELECT event_id AS id, ts AS created_at, user_id AS player_id,
       CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'purchase' THEN 'stake' WHEN 'click' THEN 'win'
                       WHEN 'view' THEN 'withdrawal' ELSE 'bonus' END AS type,
       CASE WHEN event_type = 'error' THEN 'bonus' ELSE 'cash' END AS account,
       CASE WHEN event_type IN ('purchase', 'view') THEN -CAST(value AS DECIMAL(14,2))
            ELSE CAST(value AS DECIMAL(14,2)) END AS amount
FROM events""",
    "odds_feed_v": """SELECT event_id AS id, ts AS changed_at, user_id AS selection_id,
       CAST(1.01 + CAST(event_id % 900 AS DECIMAL(7,3)) / 100 AS DECIMAL(7,3)) AS odds
FROM events WHERE event_type IN ('view', 'click')""",
    "session_samples_v": """SELECT date_trunc('day', ts) AS sample, user_id AS pid, user_id % 7 AS blocking_user,
       CASE WHEN user_id % 10 = 0 THEN CAST(NULL AS BIGINT) ELSE user_id - 1 END AS blocker_pid,
       min(ts) AS xact_start
FROM events GROUP BY 1, 2, 3, 4""",
}


def with_adapters(sql: str, *names: str) -> str:
    """Prefix an oracle query with the adapter CTEs it names."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{ADAPTER_SQL[n]}\n)" for n in names)
    body = sql.lstrip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
