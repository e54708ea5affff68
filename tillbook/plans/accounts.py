"""What sign-ups, logins and the shipping run leave behind (M17, M21, M05): audit rows with JSON details, last
logins, the shop's customers and addresses, and the new order and shipment tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import pick, ts_lit
from tillbook.plans.book_jobs import apply_logins
from tillbook.plans.registry import register
from tillbook.plans.shop_build import CITIES, STREETS, _arr_sql
from tillbook.plans.shop_jobs import SHOP_AS_OF
from tillbook.sources.adapters import Tables

CARRIERS = 6


def audit(rows: DataFrame, actor: str, action: str, entity: str, entity_id, details=None) -> DataFrame:
    """Audit rows of ``rows`` (ts): who did what to which entity, with JSON details or none."""
    return rows.select(F.concat(F.lit(f"{actor}:"), entity_id.cast("string")).alias("actor"), F.lit(action).alias("action"),
                       F.lit(entity).alias("entity"), entity_id.alias("entity_id"),
                       (F.lit(None).cast("string") if details is None else F.to_json(details)).alias("details"), F.col("ts").alias("created_at"))


def login_audit(outcomes: DataFrame) -> DataFrame:
    """An audit row for every login that was let in (channel and address in the details)."""
    return audit(outcomes.filter(F.col("result") == "ok"), "player", "login", "player", F.col("player_id"), F.struct("channel", "ip"))


def shop_signups(requests: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M17 in the shop: a customer, their shipping address and an audit row for every request (request_id, ts)."""
    k = F.col("request_id")
    customers = requests.select(k.alias("id"), F.concat(F.lit("customer"), k.cast("string"), F.lit("@example.com")).alias("email"),
                                F.lit("active").alias("status"), F.col("ts").alias("created_at"))
    addresses = requests.select(k.alias("customer_id"), F.lit("shipping").alias("kind"),
                                F.concat((1 + k % 150).cast("string"), F.lit(" "), pick(k, STREETS)).alias("street"), pick(k, CITIES).alias("city"))
    return customers, addresses, audit(requests, "customer", "signup", "customer", k)


def ship_and_deliver(orders: DataFrame, shipments: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """The new order and shipment tables. Paid orders are shipped and get a shipment (id = -order id) in transit;
    shipments in transit for over two minutes are delivered, and so are their orders."""
    now = ts_lit(as_of)
    due = F.col("delivered_at").isNull() & (F.col("shipped_at") < now - F.make_dt_interval(mins=F.lit(2)))
    old = shipments.withColumn("_due", F.coalesce(due, F.lit(False)))
    done = old.filter("_due").select(F.col("order_id").alias("_order")).distinct()
    status = F.when(F.col("_order").isNotNull(), "delivered").when(F.col("status") == "paid", "shipped").otherwise(F.col("status"))
    new_orders = orders.join(done, F.col("id") == F.col("_order"), "left").withColumn("status", status).drop("_order")
    added = orders.filter(F.col("status") == "paid").select(
        (-F.col("id")).alias("id"), F.col("id").alias("order_id"), (1 + F.col("id") % CARRIERS).cast("int").alias("carrier_id"),
        F.concat(F.lit("TRK"), F.left(F.md5(F.col("id").cast("string")), F.lit(12))).alias("tracking_number"), F.lit("in_transit").alias("status"),
        now.alias("shipped_at"), F.lit(None).cast("timestamp_ntz").alias("delivered_at"))
    kept = old.select("id", "order_id", "carrier_id", F.lit(None).cast("string").alias("tracking_number"),
                      F.when(F.col("_due") | F.col("delivered_at").isNotNull(), "delivered").otherwise("in_transit").alias("status"), "shipped_at",
                      F.when(F.col("_due"), now).otherwise(F.col("delivered_at")).alias("delivered_at"))
    return new_orders, kept.unionByName(added)


def _logins(t: Tables) -> DataFrame:
    e = t.events.filter(F.col("event_type") == "click")
    return e.select(F.col("event_id").alias("request_id"), F.col("user_id").alias("player_id"), "ts")


@register("login_audit", adapters=("players_v",), oracle="""
SELECT 'player:' || CAST(user_id AS VARCHAR) AS actor, 'login' AS action, 'player' AS entity, user_id AS entity_id,
       '{"channel":"' || ['web', 'app', 'shop'][1 + event_id % 3] || '","ip":"203.0.113.' || CAST(1 + event_id % 254 AS VARCHAR) || '"}' AS details,
       ts AS created_at
FROM events JOIN players_v ON id = user_id AND status = 'active' WHERE event_type = 'click'""")
def q_login_audit(spark, d):
    t = Tables(spark, d)
    outcomes, _, _ = apply_logins(_logins(t), t.players_v)
    k = F.col("request_id")
    ip = F.concat(F.lit("203.0.113."), (1 + k % 254).cast("string"))
    return login_audit(outcomes.withColumns({"channel": pick(k, ("web", "app", "shop")), "ip": ip}))


@register("last_logins", adapters=("players_v",), oracle="""
SELECT user_id AS player_id, max(ts) AS last_login_at FROM events
WHERE event_type = 'click' AND user_id IN (SELECT id FROM players_v WHERE status = 'active') GROUP BY 1""")
def q_last_logins(spark, d):
    t = Tables(spark, d)
    return apply_logins(_logins(t), t.players_v)[2]


@register("shop_signups", oracle=f"""
SELECT event_id AS id, 'customer' || CAST(event_id AS VARCHAR) || '@example.com' AS email, 'active' AS status, ts AS created_at, 'shipping' AS kind,
       CAST(1 + event_id % 150 AS VARCHAR) || ' ' || {_arr_sql(STREETS)}[1 + event_id % {len(STREETS)}] AS street,
       {_arr_sql(CITIES)}[1 + event_id % {len(CITIES)}] AS city, 'customer:' || CAST(event_id AS VARCHAR) AS actor, 'signup' AS action
FROM events WHERE event_type = 'signup'""")
def q_shop_signups(spark, d):
    """Customer, address and audit row of every sign-up."""
    requests = Tables(spark, d).events.filter(F.col("event_type") == "signup").select(F.col("event_id").alias("request_id"), "ts")
    customers, addresses, rows = shop_signups(requests)
    return (customers.join(addresses.withColumnRenamed("customer_id", "id"), "id")
            .join(rows.select(F.col("entity_id").alias("id"), "actor", "action"), "id"))


_DUE_SQL = f"delivered_at IS NULL AND shipped_at < TIMESTAMP '{SHOP_AS_OF}' - INTERVAL 2 MINUTE"


@register("shipped_orders", adapters=("orders_v", "shipments_v"), oracle=f"""
SELECT id, CASE WHEN id IN (SELECT order_id FROM shipments_v WHERE {_DUE_SQL}) THEN 'delivered' WHEN status = 'paid' THEN 'shipped' ELSE status END AS status
FROM orders_v""")
def q_shipped_orders(spark, d):
    t = Tables(spark, d)
    return ship_and_deliver(t.orders_v, t.shipments_v, SHOP_AS_OF)[0].select("id", "status")


@register("shipped_shipments", adapters=("orders_v", "shipments_v"), oracle=f"""
SELECT id, order_id, carrier_id, CAST(NULL AS VARCHAR) AS tracking_number, CASE WHEN delivered_at IS NOT NULL OR ({_DUE_SQL}) THEN 'delivered' ELSE 'in_transit' END AS status,
       shipped_at, CASE WHEN {_DUE_SQL} THEN TIMESTAMP '{SHOP_AS_OF}' ELSE delivered_at END AS delivered_at
FROM shipments_v
UNION ALL
SELECT -id, id, CAST(1 + id % {CARRIERS} AS INT), 'TRK' || left(md5(CAST(id AS VARCHAR)), 12), 'in_transit', TIMESTAMP '{SHOP_AS_OF}', NULL
FROM orders_v WHERE status = 'paid'""")
def q_shipped_shipments(spark, d):
    t = Tables(spark, d)
    return ship_and_deliver(t.orders_v, t.shipments_v, SHOP_AS_OF)[1]
