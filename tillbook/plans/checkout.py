"""The whole checkout (M03, G01): orders given as JSON items, applied in request order against finite stock,
with every row that an accepted order brings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import ts_lit
from tillbook.operators.admission import spread, stored
from tillbook.operators.joins import first_per_key
from tillbook.plans.build import PAYMENT_METHODS
from tillbook.plans.registry import register
from tillbook.plans.shop_jobs import _CHECKOUT_FIX_SQL, SHOP_AS_OF, opening_stock, place_orders
from tillbook.sources.adapters import Tables

ITEMS = "array<struct<product_id: bigint, quantity: int>>"
MONEY = "decimal(12,2)"


def order_lines(requests: DataFrame) -> DataFrame:
    """request_id, warehouse_id, line, product_id, quantity of every item of the requests' JSON lists."""
    lines = F.posexplode(F.from_json("items", ITEMS)).alias("line", "i")
    return requests.select("request_id", "warehouse_id", lines).select(
        "request_id", "warehouse_id", (F.col("line") + 1).alias("line"), "i.product_id", "i.quantity")


def stored_lines(requests: DataFrame) -> tuple[DataFrame, int]:
    """The requests' lines with their place in the order of requests, written once, and their number."""
    return stored(order_lines(requests).withColumn("seq", F.col("request_id")))


def checkout(requests: DataFrame, products: DataFrame, stock: DataFrame, addresses: DataFrame, carts: DataFrame, as_of: str,
             lines: tuple[DataFrame, int] | None = None, keep_orders: bool = False) -> dict[str, DataFrame]:
    """Apply ``requests`` (request_id, customer_id, warehouse_id, items, method, provider_ref) one by one in id order.

    Returns outcomes (ok, out_of_stock, or invalid_items if the list does not parse) and, of the accepted
    requests, orders, items, movements, payments, audit rows, and the new carts: a customer's open ones are converted.
    A request with an empty list gives an order of nothing. The order's id is its request's. ``lines``: the requests'
    lines, if they are a stored table, and their number. ``keep_orders``: the orders are written once, for a caller
    that reads several of orders, payments and audit rows.
    """
    lines, rows = lines or stored_lines(requests)
    decided, _, movements = place_orders(lines, stock, rows=rows)
    n_items = F.size(F.from_json("items", ITEMS))
    stock_result = spread(decided.select("request_id", F.col("result").alias("_stock")), rows, "request_id")
    judged = spread(requests, rows, "request_id").withColumn("n_items", n_items).join(stock_result, "request_id", "left")
    result = F.when(F.col("n_items").isNull(), "invalid_items").otherwise(F.coalesce("_stock", F.lit("ok")))
    judged = judged.withColumn("result", result).drop("_stock")
    accepted = judged.filter(F.col("result") == "ok")

    bought = spread(lines, rows, "request_id").join(accepted.select("request_id"), "request_id")
    priced = (spread(bought, rows, "product_id")
              .join(products.select(F.col("id").alias("product_id"), F.col("price").alias("unit_price")), "product_id"))
    totals = spread(priced.select("request_id", "unit_price", "quantity"), rows, "request_id").groupBy("request_id").agg(F.sum(F.col("unit_price") * F.col("quantity")).alias("_total"))
    to = first_per_key(addresses.filter(F.col("kind") == "shipping"), "customer_id", ["id"], ["id"]).withColumnRenamed("id", "shipping_address_id")
    orders = (accepted.join(totals, "request_id", "left").join(to, "customer_id", "left")
              .withColumn("total_amount", F.coalesce("_total", F.lit(0)).cast(MONEY)))
    if keep_orders:
        orders, _ = stored(orders.select("request_id", "customer_id", "shipping_address_id", "total_amount", "method", "provider_ref", "n_items"))
    details = F.to_json(F.struct(F.col("n_items").alias("items"), F.col("total_amount").cast("string").alias("total")))
    order_id = F.col("request_id").alias("order_id")
    buyers = accepted.select("customer_id").distinct().withColumn("_bought", F.lit(True))
    converted = (F.col("status") == "open") & F.col("_bought").isNotNull()
    return {
        "outcomes": judged.select("request_id", "customer_id", "result"),
        "orders": orders.select(order_id, "customer_id", "shipping_address_id", F.lit("pending").alias("status"), "total_amount",
                                ts_lit(as_of).alias("created_at")),
        "items": priced.select(order_id, "line", "product_id", "quantity", "unit_price"),
        "movements": movements,
        "payments": orders.select(order_id, F.col("total_amount").alias("amount"), "method", F.lit("pending").alias("status"), "provider_ref"),
        "audit": orders.select(F.concat(F.lit("customer:"), F.col("customer_id").cast("string")).alias("actor"), F.lit("checkout").alias("action"),
                               F.lit("order").alias("entity"), F.col("request_id").alias("entity_id"), details.alias("details")),
        "carts": (carts.join(buyers, "customer_id", "left")
                  .withColumn("status", F.when(converted, "converted").otherwise(F.col("status"))).drop("_bought")),
    }


def _checkout(spark, d, keep_orders: bool = False) -> dict[str, DataFrame]:
    """The fixture's orders as requests; customers' addresses and carts follow from their ids."""
    t = Tables(spark, d)
    key = F.col("o_orderkey")
    n = t.lineitem.count()
    listed = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), n, "l_orderkey").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity")))).alias("l"))
    items = F.to_json(F.transform("l", lambda x: F.struct(x.product_id.alias("product_id"), x.quantity.alias("quantity"))))
    requests = spread(t.orders, n, "o_orderkey").join(listed, F.col("l_orderkey") == key).select(
        key.alias("request_id"), F.col("o_custkey").alias("customer_id"), (1 + key % 5).cast("int").alias("warehouse_id"), items.alias("items"),
        F.element_at(F.array(*map(F.lit, PAYMENT_METHODS)), (1 + key % 6).cast("int")).alias("method"),
        F.concat(F.lit("PSP-"), F.left(F.md5(key.cast("string")), F.lit(16))).alias("provider_ref"))
    requests, _ = stored(requests)
    lines, rows = stored_lines(requests)
    c = F.col("c_custkey")
    addresses = t.customer.filter(c % 7 != 0).select(c.alias("customer_id"), F.explode(F.array(
        F.struct((c * 3).alias("id"), F.lit("billing").alias("kind")), F.struct((c * 3 + 2).alias("id"), F.lit("shipping").alias("kind")),
        F.struct((c * 3 + 1).alias("id"), F.lit("shipping").alias("kind")))).alias("a")).select("customer_id", "a.*")
    carts = t.customer.select(c.alias("id"), c.alias("customer_id"), F.when(c % 3 == 0, "open").otherwise("abandoned").alias("status"))
    return checkout(requests, t.products_v, opening_stock(lines, rows), addresses, carts, SHOP_AS_OF, (lines, rows), keep_orders)


_ACCEPTED_SQL = _CHECKOUT_FIX_SQL + """,
ok AS (SELECT DISTINCT request_id FROM fix WHERE it = (SELECT max(it) FROM fix) AND acc),
li AS (SELECT l_orderkey AS k, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
              row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, CAST(l_quantity AS INT)) AS line
       FROM lineitem JOIN part ON p_partkey = l_partkey SEMI JOIN ok ON request_id = l_orderkey),
tot AS (SELECT k, count(*) AS n, CAST(sum(quantity * unit_price) AS DECIMAL(12,2)) AS total FROM li GROUP BY k)
"""


@register("checkout_orders", oracle=_ACCEPTED_SQL + f"""
SELECT k AS order_id, o_custkey AS customer_id, CASE WHEN o_custkey % 7 <> 0 THEN o_custkey * 3 + 1 END AS shipping_address_id,
       'pending' AS status, total AS total_amount, TIMESTAMP '{SHOP_AS_OF}' AS created_at, total AS paid,
       {list(PAYMENT_METHODS)!r}[1 + k % 6] AS method, 'pending' AS payment_status, 'PSP-' || left(md5(CAST(k AS VARCHAR)), 16) AS provider_ref,
       'customer:' || CAST(o_custkey AS VARCHAR) AS actor, '{{"items":' || CAST(n AS VARCHAR) || ',"total":"' || CAST(total AS VARCHAR) || '"}}' AS details
FROM tot JOIN orders ON o_orderkey = k""")
def q_checkout_orders(spark, d):
    """The orders of accepted requests with their pending payment and audit row."""
    out = _checkout(spark, d, keep_orders=True)
    payments = out["payments"].select("order_id", F.col("amount").alias("paid"), "method", F.col("status").alias("payment_status"), "provider_ref")
    audit = out["audit"].select(F.col("entity_id").alias("order_id"), "actor", "details")
    return out["orders"].join(payments, "order_id").join(audit, "order_id")


@register("checkout_items", oracle=_ACCEPTED_SQL + "SELECT k AS order_id, CAST(line AS INT) AS line, product_id, quantity, unit_price FROM li")
def q_checkout_items(spark, d):
    return _checkout(spark, d)["items"]


@register("checkout_carts", oracle=_ACCEPTED_SQL + """
SELECT c_custkey AS id, c_custkey AS customer_id,
       CASE WHEN c_custkey % 3 <> 0 THEN 'abandoned'
            WHEN c_custkey IN (SELECT o_custkey FROM orders SEMI JOIN ok ON request_id = o_orderkey) THEN 'converted' ELSE 'open' END AS status
FROM customer""")
def q_checkout_carts(spark, d):
    return _checkout(spark, d)["carts"]
