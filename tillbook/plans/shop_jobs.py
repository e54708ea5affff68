"""Shop table-change pipelines (M01-M05, M18-M20): each returns new tables and outcome rows;
nothing is updated in place (Parquet has no row updates; a caller writes the new version)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions import changed, trunc_ts, ts_lit
from tillbook.operators.admission import admit, spread, stored
from tillbook.operators.joins import anti_join
from tillbook.operators.windows import latest_per_key
from tillbook.plans.registry import register
from tillbook.session import EVENTS_AS_OF
from tillbook.sources.adapters import Tables

CART_AS_OF = EVENTS_AS_OF              # the clean-up runs at the end of the events
UPSERT_AS_OF = "2024-01-30 12:00:00"   # carts before this time, requests after it
SHOP_AS_OF = "2001-08-02 00:00:00"


def _minutes(n: int):
    return F.make_dt_interval(mins=F.lit(n))


# ---- fixtures derived from the events table ---------------------------------------------------

def carts_from_events(events: DataFrame, products: Column, as_of: str):
    """Carts (one per user and day, guests = user_id % 5 == 0) and their items, as of ``as_of``; ``products`` is the
    number of products, over all of which the items are spread."""
    e = events.filter(F.col("ts") <= ts_lit(as_of))
    carts = (e.groupBy("user_id", trunc_ts("day", "ts").alias("day"))
             .agg(F.min("event_id").alias("id"), F.min("ts").alias("created_at"), F.max("ts").alias("updated_at"),
                  F.count_if(F.col("event_type") == "purchase").alias("_buys"),
                  F.count_if(F.col("event_type") == "error").alias("_errors")))
    carts = carts.select(
        "id", "user_id", "day",
        F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("customer_id"),
        F.when(F.col("_buys") > 0, "converted").when(F.col("_errors") > 0, "abandoned").otherwise("open").alias("status"),
        "created_at", "updated_at")
    items = (e.filter(F.col("event_type").isin("view", "click"))
             .select("user_id", trunc_ts("day", "ts").alias("day"), (F.col("event_id") % products).alias("product_id"))
             .join(carts.select(F.col("id").alias("cart_id"), "user_id", "day"), ["user_id", "day"])
             .groupBy("cart_id", "product_id").agg(F.count(F.lit(1)).cast("int").alias("quantity")))
    return carts.drop("user_id", "day"), items


def n_products(t: Tables) -> Column:
    """The number of products: a scalar subquery."""
    return t.part.agg(F.max("p_partkey")).scalar()


_CARTS_SQL = f"""WITH e AS (SELECT * FROM events WHERE ts <= TIMESTAMP '{CART_AS_OF}'),
g AS (SELECT user_id, date_trunc('day', ts) AS day, min(event_id) AS id, min(ts) AS created_at, max(ts) AS updated_at,
             count(*) FILTER (WHERE event_type = 'purchase') AS buys, count(*) FILTER (WHERE event_type = 'error') AS errs
      FROM e GROUP BY 1, 2),
carts AS (SELECT id, user_id, day, CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END AS customer_id,
                 CASE WHEN buys > 0 THEN 'converted' WHEN errs > 0 THEN 'abandoned' ELSE 'open' END AS status,
                 created_at, updated_at FROM g),
items AS (SELECT c.id AS cart_id, e.event_id % (SELECT max(p_partkey) FROM part) AS product_id, CAST(count(*) AS INT) AS quantity
          FROM e JOIN carts c ON c.user_id = e.user_id AND c.day = date_trunc('day', e.ts)
          WHERE e.event_type IN ('view', 'click') GROUP BY 1, 2),
swept AS (
  SELECT id, customer_id, CASE WHEN status = 'open' AND updated_at < TIMESTAMP '{CART_AS_OF}' - INTERVAL 30 MINUTE
                               THEN 'abandoned' ELSE status END AS status,
         CASE WHEN status = 'open' AND updated_at < TIMESTAMP '{CART_AS_OF}' - INTERVAL 30 MINUTE
              THEN TIMESTAMP '{CART_AS_OF}' ELSE updated_at END AS updated_at,
         status = 'open' AND updated_at < TIMESTAMP '{CART_AS_OF}' - INTERVAL 30 MINUTE AS just_abandoned
  FROM carts),
gone AS (SELECT id FROM swept WHERE status IN ('abandoned', 'converted')
                                AND updated_at < TIMESTAMP '{CART_AS_OF}' - INTERVAL 45 MINUTE)
"""


# ---- M01 cart clean-up --------------------------------------------------------------------------

def cleanup_carts(carts: DataFrame, items: DataFrame, as_of: str):
    """Open carts idle for 30 minutes become abandoned (and are touched: X11); abandoned and
    converted carts idle for 45 minutes are deleted with their items (J15 cascade).

    Returns (new carts, new items, one-row counts).
    """
    now = ts_lit(as_of)
    idle = (F.col("status") == "open") & (F.col("updated_at") < now - _minutes(30))
    swept = (carts.withColumn("_abandon", idle)
             .withColumn("status", F.when(F.col("_abandon"), F.lit("abandoned")).otherwise(F.col("status")))
             .withColumn("updated_at", F.when(F.col("_abandon"), now).otherwise(F.col("updated_at"))))
    gone_cond = F.col("status").isin("abandoned", "converted") & (F.col("updated_at") < now - _minutes(45))
    gone = swept.filter(gone_cond).select(F.col("id").alias("cart_id"))
    new_carts = swept.filter(~gone_cond).drop("_abandon")
    new_items = anti_join(items, gone, ["cart_id"])
    counts = swept.agg(F.count_if(F.col("_abandon")).alias("abandoned"), F.count_if(gone_cond).alias("deleted"))
    return new_carts, new_items, counts


@register("cart_cleanup", oracle=_CARTS_SQL + """
SELECT id, customer_id, status, updated_at FROM swept WHERE id NOT IN (SELECT id FROM gone)""")
def q_cart_cleanup(spark, d):
    t = Tables(spark, d)
    carts, items = carts_from_events(t.events, n_products(t), CART_AS_OF)
    new_carts, _, _ = cleanup_carts(carts, items, CART_AS_OF)
    return new_carts.select("id", "customer_id", "status", "updated_at")


@register("cart_cleanup_counts", oracle=_CARTS_SQL + """
SELECT (SELECT count(*) FROM swept WHERE just_abandoned) AS abandoned, (SELECT count(*) FROM gone) AS deleted,
       (SELECT count(*) FROM items WHERE cart_id IN (SELECT id FROM gone)) AS items_deleted,
       (SELECT count(*) FROM items WHERE cart_id NOT IN (SELECT id FROM gone)) AS items_kept""")
def q_cart_cleanup_counts(spark, d):
    t = Tables(spark, d)
    carts, items = carts_from_events(t.events, n_products(t), CART_AS_OF)
    _, new_items, counts = cleanup_carts(carts, items, CART_AS_OF)
    kept = new_items.agg(F.count(F.lit(1))).scalar()   # one-row aggregates as scalar subqueries
    total = items.agg(F.count(F.lit(1))).scalar()
    return counts.select("abandoned", "deleted", (total - kept).alias("items_deleted"), kept.alias("items_kept"))


# ---- M02 restock ----------------------------------------------------------------------------------

def inventory_from_ledger(movements: DataFrame) -> DataFrame:
    """Stock snapshot = fold of the movement ledger per (warehouse, product), nothing reserved."""
    return movements.groupBy("warehouse_id", "product_id").agg(
        F.sum("quantity").cast("int").alias("quantity"), F.lit(0).alias("reserved"))


def restock(inventory: DataFrame, threshold: int = 50, refill: int = 500):
    """Stock rows below ``threshold`` get ``refill`` units and a purchase movement each."""
    low = F.col("quantity") < threshold
    new_inv = (inventory.withColumn("restocked", low)
               .withColumn("quantity", F.when(low, F.col("quantity") + refill).otherwise(F.col("quantity"))))
    moves = new_inv.filter("restocked").select("warehouse_id", "product_id", F.lit(refill).alias("quantity"),
                                               F.lit("purchase").alias("reason"))
    return new_inv, moves


@register("restock", adapters=("stock_movements_v",), oracle="""
SELECT warehouse_id, product_id, CAST(CASE WHEN q < 50 THEN q + 500 ELSE q END AS INT) AS quantity, 0 AS reserved,
       q < 50 AS restocked
FROM (SELECT warehouse_id, product_id, sum(quantity) AS q FROM stock_movements_v GROUP BY 1, 2)""")
def q_restock(spark, d):
    inv, _ = restock(inventory_from_ledger(Tables(spark, d).stock_movements_v))
    return inv


# ---- M03 batch checkout ---------------------------------------------------------------------------

def checkout_requests(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order requests in id order: every line asks (warehouse, product) for its quantity."""
    rows = lineitem.count()
    lines = spread(lineitem.select("l_orderkey", "l_partkey", "l_quantity"), rows, "l_orderkey")
    return (spread(orders.select("o_orderkey"), rows, "o_orderkey").join(lines, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_orderkey").alias("request_id"), F.col("o_orderkey").alias("seq"),
                    (1 + F.col("o_orderkey") % 5).cast("int").alias("warehouse_id"),
                    F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity")))


def opening_stock(requests: DataFrame, rows: int = 0) -> DataFrame:
    """Finite stock per requested (warehouse, product): 20 to 59 units. ``rows``: how many lines are requested."""
    return (spread(requests.select("warehouse_id", "product_id"), rows, "warehouse_id", "product_id").distinct()
            .withColumn("cap", (F.lit(20) + F.pmod(F.col("product_id"), F.lit(40))).cast("int")))


def place_orders(requests: DataFrame, stock: DataFrame, bucket_rows: int = 1_000_000, rows: int | None = None):
    """All-or-nothing checkout in request order against finite stock (§ admission).

    ``rows``: the number of ``requests``, if they are a stored table; else they are written here. Returns (decisions, new stock, sale movements of the accepted lines).
    """
    if rows is None:
        requests, rows = stored(requests)
    key = ["warehouse_id", "product_id"]
    dec = admit(requests, stock, "request_id", "seq", key, "quantity", bucket_rows=bucket_rows, rows=rows)
    accepted_lines = spread(requests, rows, "request_id").join(spread(dec.filter("accepted").select("request_id"), rows, "request_id"), "request_id")
    used = spread(accepted_lines.select(*key, "quantity"), rows, *key).groupBy(*key).agg(F.sum("quantity").alias("used"))
    new_stock = (spread(stock, rows, *key).join(used, key, "left")
                 .select("warehouse_id", "product_id", (F.col("cap") - F.coalesce("used", F.lit(0))).alias("quantity")))
    moves = accepted_lines.select("warehouse_id", "product_id", (-F.col("quantity")).alias("quantity"),
                                  F.lit("sale").alias("reason"), F.col("request_id").alias("order_id"))
    outcome = dec.select("request_id", F.when(F.col("accepted"), "ok").otherwise("out_of_stock").alias("result"),
                         "round")
    return outcome, new_stock, moves


# The oracle runs the same fixpoint as ``admit`` in DuckDB (a recursive CTE: running sums of
# "accepted or undecided" and "accepted" quantities per key, decide, repeat). That the fixpoint
# equals the one-by-one fold is checked against plain Python in tests/test_operators.py.
_CHECKOUT_FIX_SQL = """WITH RECURSIVE
l AS (SELECT o_orderkey AS request_id, CAST(1 + o_orderkey % 5 AS INT) AS w, l_partkey AS p,
             sum(CAST(l_quantity AS INT)) AS amt
      FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
fix AS (
  SELECT 0 AS it, request_id, w, p, amt, 20 + p % 40 AS cap, CAST(NULL AS BOOLEAN) AS acc FROM l
  UNION ALL
  SELECT it + 1, request_id, w, p, amt, cap, coalesce(acc, CASE WHEN sure_ok THEN true WHEN sure_bad THEN false END)
  FROM (
    SELECT *, bool_and(hi_before + amt <= cap) OVER (PARTITION BY request_id) AS sure_ok,
              bool_or(lo_before + amt > cap) OVER (PARTITION BY request_id) AS sure_bad,
              count(*) FILTER (WHERE acc IS NULL) OVER () AS undecided
    FROM (
      SELECT *, coalesce(sum(CASE WHEN acc IS NOT false THEN amt ELSE 0 END) OVER k, 0) AS hi_before,
                coalesce(sum(CASE WHEN acc THEN amt ELSE 0 END) OVER k, 0) AS lo_before
      FROM fix WINDOW k AS (PARTITION BY w, p ORDER BY request_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
  WHERE undecided > 0)
"""


@register("place_orders", oracle=_CHECKOUT_FIX_SQL + """
SELECT DISTINCT request_id, CASE WHEN acc THEN 'ok' ELSE 'out_of_stock' END AS result
FROM fix WHERE it = (SELECT max(it) FROM fix)""")
def q_place_orders(spark, d):
    t = Tables(spark, d)
    req, rows = stored(checkout_requests(t.orders, t.lineitem))
    outcome, _, _ = place_orders(req, opening_stock(req, rows), rows=rows)
    return outcome.select("request_id", "result")


@register("checkout_stock", oracle=_CHECKOUT_FIX_SQL + """,
last AS (SELECT * FROM fix WHERE it = (SELECT max(it) FROM fix))
SELECT CAST(w AS INT) AS warehouse_id, p AS product_id,
       CAST(max(cap) - sum(CASE WHEN acc THEN amt ELSE 0 END) AS INT) AS quantity
FROM last GROUP BY 1, 2""")
def q_checkout_stock(spark, d):
    """Stock per (warehouse, product) after the batch: opening stock less the accepted lines."""
    t = Tables(spark, d)
    req, rows = stored(checkout_requests(t.orders, t.lineitem))
    _, new_stock, _ = place_orders(req, opening_stock(req, rows), rows=rows)
    return new_stock.withColumn("quantity", F.col("quantity").cast("int"))


# ---- M04 payment run ------------------------------------------------------------------------------

def _oldest(queue: DataFrame, order: list[str], n: int | None) -> DataFrame:
    return queue if n is None else queue.orderBy(*order).limit(n)


def run_payments(payments: DataFrame, orders: DataFrame, invoices: DataFrame, as_of: str, n: int | None = None,
                 declined=None):
    """All pending payments (the oldest ``n`` if given): declined -> payment failed, order cancelled; else captured,
    order paid (only if still pending) and an invoice, unless the order already has one (B07)."""
    declined = declined if declined is not None else (F.pmod(F.xxhash64("id"), F.lit(100)) < 3)
    batch = _oldest(payments.filter(F.col("status") == "pending"), ["created_at", "id"], n).withColumn("_declined", declined)
    o = orders.select(F.col("id").alias("order_id"), F.col("status").alias("order_status"))
    j = batch.join(o, "order_id", "left")
    new_order_status = (F.when(F.col("_declined"), F.lit("cancelled"))
                        .when(F.col("order_status") == "pending", F.lit("paid")).otherwise(F.col("order_status")))
    number = F.concat(F.lit("INV-"), F.date_format(ts_lit(as_of), "yyyy"), F.lit("-"),
                      F.lpad(F.col("order_id").cast("string"), 9, "0"))
    out = j.select(F.col("id").alias("payment_id"), "order_id",
                   F.when(F.col("_declined"), "failed").otherwise("captured").alias("payment_status"),
                   new_order_status.alias("order_status"), F.when(~F.col("_declined"), number).alias("_number"))
    has_inv = invoices.select(F.col("order_id").alias("_inv_order")).distinct()
    out = out.join(has_inv, F.col("_inv_order") == F.col("order_id"), "left")
    return out.select("payment_id", "order_id", "payment_status", "order_status",
                      F.when(F.col("_inv_order").isNull(), F.col("_number")).alias("new_invoice"))


@register("payment_run", adapters=("orders_v",), oracle=f"""
WITH batch AS (SELECT id, id AS order_id, created_at, id % 7 = 0 AS declined FROM orders_v WHERE status = 'pending')
SELECT b.id AS payment_id, b.order_id, CASE WHEN declined THEN 'failed' ELSE 'captured' END AS payment_status,
       CASE WHEN declined THEN 'cancelled' WHEN o.status = 'pending' THEN 'paid' ELSE o.status END AS order_status,
       CASE WHEN NOT declined AND b.order_id % 4 <> 0 THEN 'INV-2001-' || lpad(CAST(b.order_id AS VARCHAR), 9, '0') END
         AS new_invoice
FROM batch b LEFT JOIN orders_v o ON o.id = b.order_id""")
def q_payment_run(spark, d):
    o = Tables(spark, d).orders_v
    payments = o.select("id", F.col("id").alias("order_id"), F.lit("pending").alias("status"), "created_at") \
        .where(o.status == "pending")
    invoices = o.filter(F.col("id") % 4 == 0).select(F.col("id").alias("order_id"))
    return run_payments(payments, o, invoices, SHOP_AS_OF, declined=(F.col("id") % 7 == 0))


# ---- M05 shipping run -----------------------------------------------------------------------------

def run_shipping(orders: DataFrame, shipments: DataFrame, as_of: str, n: int | None = None) -> DataFrame:
    """All paid orders (the oldest ``n`` if given) are shipped (label_created + picked_up events); all (or the oldest ``n``)
    shipments in transit for over 2 minutes are delivered (one event). Returns the new events."""
    now = ts_lit(as_of)
    ship = _oldest(orders.filter(F.col("status") == "paid"), ["created_at", "id"], n)
    ship_events = ship.select(F.col("id").alias("order_id"), F.explode(F.array(
        F.struct(F.lit("label_created").alias("event"), F.lit("warehouse").alias("location")),
        F.struct(F.lit("picked_up").alias("event"), F.lit("warehouse").alias("location")))).alias("e")) \
        .select("order_id", "e.*")
    transit = _oldest(shipments.filter(F.col("delivered_at").isNull() & (F.col("shipped_at") < now - _minutes(2))),
                      ["shipped_at", "id"], n)
    deliver = transit.select("order_id", F.lit("delivered").alias("event"), F.lit("customer").alias("location"))
    return ship_events.unionByName(deliver).withColumn("created_at", now)


@register("shipping_run", adapters=("orders_v", "shipments_v"), oracle=f"""
WITH s AS (SELECT id FROM orders_v WHERE status = 'paid'),
t AS (SELECT order_id FROM shipments_v WHERE delivered_at IS NULL
        AND shipped_at < TIMESTAMP '{SHOP_AS_OF}' - INTERVAL 2 MINUTE)
SELECT id AS order_id, 'label_created' AS event, 'warehouse' AS location, TIMESTAMP '{SHOP_AS_OF}' AS created_at FROM s
UNION ALL SELECT id, 'picked_up', 'warehouse', TIMESTAMP '{SHOP_AS_OF}' FROM s
UNION ALL SELECT order_id, 'delivered', 'customer', TIMESTAMP '{SHOP_AS_OF}' FROM t""")
def q_shipping_run(spark, d):
    t = Tables(spark, d)
    return run_shipping(t.orders_v, t.shipments_v, SHOP_AS_OF)


# ---- M18 / M19 triggers as set operations ---------------------------------------------------------

def _next_version(orders: DataFrame) -> DataFrame:
    """A later version of the orders: every 7th changes status, every 13th is new."""
    nxt = F.when(F.col("status") == "pending", "paid").when(F.col("status") == "paid", "shipped") \
        .when(F.col("status") == "shipped", "delivered").otherwise(F.col("status"))
    return orders.withColumn("status", F.when(F.col("id") % 7 == 0, nxt).otherwise(F.col("status")))


def touch(old: DataFrame, new: DataFrame, keys: list[str], as_of: str, ts: str = "updated_at") -> DataFrame:
    """``updated_at = as_of`` on rows whose values changed (null-safe compare of every column)."""
    cols = [c for c in new.columns if c not in keys and c != ts]
    o = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in cols])
    j = new.join(o, keys, "left")
    diff = F.lit(False)
    for c in cols:
        diff = diff | changed(f"_old_{c}", c)
    return j.withColumn(ts, F.when(diff, ts_lit(as_of)).otherwise(F.col(ts))).drop(*[f"_old_{c}" for c in cols])


def record_status(old: DataFrame, new: DataFrame, as_of: str, key: str = "id", status: str = "status") -> DataFrame:
    """Status-history rows for inserted rows (from null) and rows whose status changed."""
    o = old.select(F.col(key).alias("_k"), F.col(status).alias("from_status"))
    j = new.select(F.col(key).alias("order_id"), F.col(status).alias("to_status")) \
        .join(o, F.col("_k") == F.col("order_id"), "left")
    return (j.filter(changed("from_status", "to_status"))
            .select("order_id", "from_status", "to_status", ts_lit(as_of).alias("changed_at")))


@register("touch_orders", adapters=("orders_v",), oracle=f"""
SELECT id, customer_id, CASE WHEN id % 7 = 0 THEN CASE status WHEN 'pending' THEN 'paid' WHEN 'paid' THEN 'shipped'
                                   WHEN 'shipped' THEN 'delivered' ELSE status END ELSE status END AS status,
       total_amount, created_at,
       CASE WHEN id % 7 = 0 AND status IN ('pending', 'paid', 'shipped') THEN TIMESTAMP '{SHOP_AS_OF}'
            ELSE created_at END AS updated_at
FROM orders_v""")
def q_touch_orders(spark, d):
    o = Tables(spark, d).orders_v.withColumn("updated_at", F.col("created_at"))
    return touch(o, _next_version(o), ["id"], SHOP_AS_OF)


@register("order_status_history", adapters=("orders_v",), oracle=f"""
WITH new AS (SELECT id, CASE WHEN id % 7 = 0 THEN CASE status WHEN 'pending' THEN 'paid' WHEN 'paid' THEN 'shipped'
                                   WHEN 'shipped' THEN 'delivered' ELSE status END ELSE status END AS status FROM orders_v),
old AS (SELECT id, status FROM orders_v WHERE id % 13 <> 0)
SELECT n.id AS order_id, o.status AS from_status, n.status AS to_status, TIMESTAMP '{SHOP_AS_OF}' AS changed_at
FROM new n LEFT JOIN old o ON o.id = n.id WHERE o.status IS DISTINCT FROM n.status""")
def q_order_status_history(spark, d):
    o = Tables(spark, d).orders_v
    return record_status(o.filter(F.col("id") % 13 != 0), _next_version(o), SHOP_AS_OF)


# ---- M20 cart upsert --------------------------------------------------------------------------------

def upsert_cart(requests: DataFrame, carts: DataFrame, items: DataFrame) -> DataFrame:
    """Add requested products to the customer's latest open cart (W04); guests and customers
    without an open cart get a new cart (id = -request id); quantities add up on conflict.
    Returns the items of every touched cart."""
    latest = latest_per_key(carts.filter((F.col("status") == "open") & F.col("customer_id").isNotNull()),
                            ["customer_id"], ["updated_at", "id"], ["id"]).withColumnRenamed("id", "open_cart")
    r = requests.join(latest, "customer_id", "left").withColumn(
        "cart_id", F.coalesce(F.col("open_cart"), -F.col("request_id")))
    add = r.select("cart_id", "product_id", "quantity")
    touched = add.select("cart_id").distinct()
    old = items.join(touched, "cart_id", "left_semi")
    return old.unionByName(add).groupBy("cart_id", "product_id").agg(F.sum("quantity").cast("int").alias("quantity"))


@register("cart_upsert", oracle=_CARTS_SQL.replace(CART_AS_OF, UPSERT_AS_OF) + f""",
req AS (SELECT event_id AS request_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE user_id END AS customer_id,
               event_id % (SELECT max(p_partkey) FROM part) AS product_id, CAST(1 + event_id % 3 AS INT) AS quantity FROM events
        WHERE event_type = 'click' AND ts > TIMESTAMP '{UPSERT_AS_OF}'),
lat AS (SELECT customer_id, arg_max(id, (updated_at, id)) AS open_cart FROM carts
        WHERE status = 'open' AND customer_id IS NOT NULL GROUP BY 1),
r AS (SELECT coalesce(l.open_cart, -q.request_id) AS cart_id, q.product_id, q.quantity FROM req q
      LEFT JOIN lat l ON l.customer_id = q.customer_id),
allrows AS (SELECT cart_id, product_id, quantity FROM items WHERE cart_id IN (SELECT cart_id FROM r)
            UNION ALL SELECT * FROM r)
SELECT cart_id, product_id, CAST(sum(quantity) AS INT) AS quantity FROM allrows GROUP BY 1, 2""")
def q_cart_upsert(spark, d):
    t = Tables(spark, d)
    ev = t.events
    carts, items = carts_from_events(ev, n_products(t), UPSERT_AS_OF)
    req = ev.filter((F.col("event_type") == "click") & (F.col("ts") > ts_lit(UPSERT_AS_OF))).select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id")).alias("customer_id"),
        (F.col("event_id") % n_products(t)).alias("product_id"), (1 + F.col("event_id") % 3).cast("int").alias("quantity"))
    return upsert_cart(req, carts, items)
