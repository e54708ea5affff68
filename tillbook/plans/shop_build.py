"""Shop catalogue and customer builds (B05-B11, B18, B26, B27) and the function families
they exercise (F09 arrays, F10 JSON, F12 maps / EAV pivot, P05 / P06 classifiers, W04, T04, M10)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.functions import classify_error, outcome_class, pick, skewed_key, skewed_key_sql, uniform, uniform_sql
from tillbook.operators.windows import latest_per_key
from tillbook.plans.build import cross_list, fan_out
from tillbook.plans.registry import register
from tillbook.plans.shop_jobs import CART_AS_OF, carts_from_events, n_products
from tillbook.session import scratch_path
from tillbook.sources.adapters import Tables

# Product name words, customer names, street and city lists, attribute names.
NAME_WORDS_1 = ("Classic", "Smart", "Eco", "Ultra", "Mini", "Pro", "Max", "Lite", "Urban", "Nordic")
NAME_WORDS_2 = ("Lamp", "Chair", "Kettle", "Backpack", "Headphones", "Jacket", "Blender", "Drill", "Tent", "Watch",
                "Speaker", "Mug")
FIRST_NAMES = ("Anna", "Ben", "Clara", "David", "Elena", "Felix", "Greta", "Hugo", "Ivana", "Jonas",
               "Katya", "Leo", "Maria", "Nikola", "Olga", "Peter", "Rosa", "Simeon", "Tara", "Viktor")
LAST_NAMES = ("Petrov", "Schmidt", "Garcia", "Rossi", "Novak", "Jansen", "Dubois", "Kowalski", "Silva", "Larsen",
              "Ivanova", "Murphy", "Horvat", "Nagy", "Popescu", "Smith", "Berg", "Costa", "Weber", "Moreau")
STREETS = ("Main Street", "Station Road", "Park Avenue", "Church Lane", "Market Square", "River Road")
CITIES = ("Sofia", "Berlin", "Madrid", "Paris", "Rome", "Vienna", "Warsaw", "Lisbon", "Dublin", "Prague")
ATTRIBUTES = ("color", "size", "material", "warranty")
CART_STATUSES = ("open", "open", "abandoned", "abandoned", "abandoned", "converted")


def _arr_sql(values) -> str:
    return "[" + ", ".join("'" + v + "'" for v in values) + "]"


# ---- B08 catalogue --------------------------------------------------------------------------------

def build_catalog(ids: DataFrame, suppliers: DataFrame, brands: int = 25, seed: int = 42) -> DataFrame:
    """Products 1..n: SKU, a name from two word lists and the id, brand by ``g*7 mod n``,
    supplier by ``g mod n`` (bounds as a one-row aggregate), hashed price, every 50th inactive."""
    sb = suppliers.agg(F.min("s_suppkey").alias("s_lo"), F.count(F.lit(1)).alias("s_n"))
    s_lo, s_n = sb.select("s_lo").scalar(), sb.select("s_n").scalar()   # scalar subqueries (J05)
    g = F.col("g")
    name = F.concat_ws(" ", pick(g, NAME_WORDS_1), pick(F.floor(g / 10), NAME_WORDS_2), g.cast("string"))
    return ids.select(
        g.alias("id"), F.concat(F.lit("SKU-"), F.lpad(g.cast("string"), 8, "0")).alias("sku"), name.alias("name"),
        (1 + (g * 7) % brands).cast("int").alias("brand_id"), (s_lo + g % s_n).alias("supplier_id"),
        F.round(F.lit(4.99) + uniform(seed, 20, g) * 495, 2).cast("decimal(10,2)").alias("price"),
        (g % 50 != 0).alias("active"))


@register("catalog_build", oracle="""
WITH sb AS (SELECT min(s_suppkey) AS lo, count(*) AS n FROM supplier)
SELECT p_partkey AS id, 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS sku,
       """ + _arr_sql(NAME_WORDS_1) + """[1 + p_partkey % 10] || ' ' || """ + _arr_sql(NAME_WORDS_2)
          + """[1 + (p_partkey // 10) % 12] || ' ' || CAST(p_partkey AS VARCHAR) AS name,
       CAST(1 + (p_partkey * 7) % 25 AS INT) AS brand_id, sb.lo + p_partkey % sb.n AS supplier_id,
       CAST(round(4.99e0 + """ + uniform_sql(42, 20, "p_partkey") + """ * 495, 2) AS DECIMAL(10,2)) AS price,
       p_partkey % 50 <> 0 AS active
FROM part, sb""")
def q_catalog_build(spark, d):
    t = Tables(spark, d)
    return build_catalog(t.part.select(F.col("p_partkey").alias("g")), t.supplier)


# ---- B05 / F12: attributes (EAV) and their pivot --------------------------------------------------------

def product_attributes(products: DataFrame) -> DataFrame:
    """Product x the literal attribute list (exploded array, no cartesian join)."""
    return cross_list(products.select(F.col("id").alias("product_id")), [{"name": a} for a in ATTRIBUTES]) \
        .withColumn("value", F.concat(F.col("name"), F.lit("-"), (F.col("product_id") % 7).cast("string")))


@register("attributes_pivot", adapters=("products_v",), oracle="""
SELECT id AS product_id, 'color-' || CAST(id % 7 AS VARCHAR) AS color, 'size-' || CAST(id % 7 AS VARCHAR) AS size,
       'material-' || CAST(id % 7 AS VARCHAR) AS material, 'warranty-' || CAST(id % 7 AS VARCHAR) AS warranty,
       'size-' || CAST(id % 7 AS VARCHAR) AS size_from_map
FROM products_v""")
def q_attributes_pivot(spark, d):
    """EAV rows pivoted over the fixed attribute list, plus a map lookup of one attribute."""
    attrs = product_attributes(Tables(spark, d).products_v)
    piv = attrs.groupBy("product_id").pivot("name", list(ATTRIBUTES)).agg(F.first("value"))
    maps = attrs.groupBy("product_id").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("m"))   # 4 entries per product
    return piv.join(maps.select("product_id", F.element_at("m", F.lit("size")).alias("size_from_map")), "product_id")


# ---- B06 / B11 inventory and opening purchases ------------------------------------------------------------

def build_inventory(products: DataFrame, warehouses: int = 5, seed: int = 42):
    """B06 + B11: every product in every warehouse (the warehouse list is a fixed literal, so
    the cross product is an explode, not a join), about 2% out of stock; the opening stock
    arrives as purchase movements of quantity + 100."""
    inv = fan_out(products.select(F.col("id").alias("product_id")), F.lit(warehouses), "warehouse_id")
    q = F.when(uniform(seed, 30, "product_id", "warehouse_id") < 0.02, F.lit(0)) \
        .otherwise(50 + F.floor(uniform(seed, 31, "product_id", "warehouse_id") * 950)).cast("int")
    inv = inv.select(F.col("warehouse_id").cast("int"), "product_id", q.alias("quantity"), F.lit(0).alias("reserved"))
    purchases = inv.select("warehouse_id", "product_id", (F.col("quantity") + 100).alias("quantity"),
                           F.lit("purchase").alias("reason"))
    return inv, purchases


@register("inventory_build", adapters=("products_v",), oracle=f"""
SELECT CAST(w AS INT) AS warehouse_id, p.id AS product_id,
       CAST(CASE WHEN {uniform_sql(42, 30, "p.id", "w")} < 0.02e0 THEN 0
                 ELSE 50 + floor({uniform_sql(42, 31, "p.id", "w")} * 950) END AS INT) AS quantity, 0 AS reserved
FROM products_v p, range(1, 6) r(w)""")
def q_inventory_build(spark, d):
    inv, _ = build_inventory(Tables(spark, d).products_v)
    return inv


# ---- B10 customers and addresses ----------------------------------------------------------------------

def build_customers(ids: DataFrame, nation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Customers (names by id modulo, country by id over the sorted country list) and their
    addresses: a default shipping address each, a billing address for even ids."""
    # the sorted country list: 25 fixed rows, one array value (scalar subquery)
    codes = nation.agg(F.array_sort(F.collect_list("n_name")).alias("codes")).scalar()
    g = F.col("g")
    cust = ids.select(
        g.alias("id"), F.concat(F.lit("customer"), g.cast("string"), F.lit("@example.com")).alias("email"),
        pick(g, FIRST_NAMES).alias("first_name"), pick(F.floor(g / 20), LAST_NAMES).alias("last_name"),
        F.element_at(codes, (1 + g % F.size(codes)).cast("int")).alias("country_code"),
        F.when(g % 97 == 0, "closed").when(g % 53 == 0, "suspended").otherwise("active").alias("status"),
        (g % 3 == 0).alias("marketing_opt_in"))
    c = F.col("id")
    ship = F.struct(F.lit("shipping").alias("kind"),
                    F.concat((1 + c % 250).cast("string"), F.lit(" "), pick(c, STREETS)).alias("line1"),
                    F.lit(True).alias("is_default"))
    bill = F.struct(F.lit("billing").alias("kind"), F.concat((1 + c % 120).cast("string"), F.lit(" Office Park"))
                    .alias("line1"), F.lit(False).alias("is_default"))
    # one or two addresses per customer from one pass (an explode, not a union of two scans)
    addresses = cust.select(c.alias("customer_id"), pick(c, CITIES).alias("city"),
                            F.lpad((c % 99999).cast("string"), 5, "0").alias("postal_code"), "country_code",
                            F.explode(F.when(c % 2 == 0, F.array(ship, bill)).otherwise(F.array(ship))).alias("a"))
    return cust, addresses.select("customer_id", "a.kind", "a.line1", "city", "postal_code", "country_code",
                                  "a.is_default")


@register("addresses_build", oracle="""
WITH codes AS (SELECT list(n_name ORDER BY n_name) AS codes FROM nation),
c AS (SELECT c_custkey AS id, codes[1 + c_custkey % len(codes)] AS country_code FROM customer, codes)
SELECT id AS customer_id, 'shipping' AS kind,
       CAST(1 + id % 250 AS VARCHAR) || ' ' || """ + _arr_sql(STREETS) + """[1 + id % 6] AS line1,
       """ + _arr_sql(CITIES) + """[1 + id % 10] AS city, lpad(CAST(id % 99999 AS VARCHAR), 5, '0') AS postal_code,
       country_code, true AS is_default FROM c
UNION ALL
SELECT id, 'billing', CAST(1 + id % 120 AS VARCHAR) || ' Office Park', """ + _arr_sql(CITIES) + """[1 + id % 10],
       lpad(CAST(id % 99999 AS VARCHAR), 5, '0'), country_code, false FROM c WHERE id % 2 = 0""")
def q_addresses_build(spark, d):
    t = Tables(spark, d)
    _, addresses = build_customers(t.customer.select(F.col("c_custkey").alias("g")), t.nation)
    return addresses


@register("customers_build", oracle="""
WITH codes AS (SELECT list(n_name ORDER BY n_name) AS codes FROM nation)
SELECT c_custkey AS id, 'customer' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       """ + _arr_sql(FIRST_NAMES) + """[1 + c_custkey % 20] AS first_name,
       """ + _arr_sql(LAST_NAMES) + """[1 + (c_custkey // 20) % 20] AS last_name,
       codes[1 + c_custkey % len(codes)] AS country_code,
       CASE WHEN c_custkey % 97 = 0 THEN 'closed' WHEN c_custkey % 53 = 0 THEN 'suspended' ELSE 'active' END AS status,
       c_custkey % 3 = 0 AS marketing_opt_in
FROM customer, codes""")
def q_customers_build(spark, d):
    t = Tables(spark, d)
    customers, _ = build_customers(t.customer.select(F.col("c_custkey").alias("g")), t.nation)
    return customers


# ---- B07 insert-ignore, B26 carts, B27 engagement ----------------------------------------------------

def insert_ignore(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is neither already present nor a duplicate of an earlier
    new row (first by ``order`` wins: deterministic, unlike dropDuplicates)."""
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in new.columns if c not in keys]),
                                            F.struct(*order)).alias("_r")).select(*keys, "_r.*")
    return first.join(existing.select(*keys).distinct(), keys, "left_anti")


@register("wishlist_insert_ignore", oracle="""
WITH new AS (SELECT user_id AS customer_id, (user_id * 13 + event_id % 3) % (SELECT max(p_partkey) FROM part) AS product_id, min(ts) AS added_at FROM events
             WHERE event_type = 'view' GROUP BY 1, 2),
existing AS (SELECT DISTINCT user_id AS customer_id, (user_id * 13 + event_id % 3) % (SELECT max(p_partkey) FROM part) AS product_id FROM events WHERE event_type = 'click')
SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.customer_id = n.customer_id
                                                                   AND e.product_id = n.product_id)""")
def q_wishlist_insert_ignore(spark, d):
    """B07 on wishlists: products viewed become wishlist rows unless the pair exists already."""
    t = Tables(spark, d)
    product = ((F.col("user_id") * 13 + F.col("event_id") % 3) % n_products(t)).alias("product_id")
    e = t.events.select("event_type", F.col("user_id").alias("customer_id"), product, F.col("ts").alias("added_at"))
    new = e.filter(F.col("event_type") == "view").drop("event_type")
    existing = e.filter(F.col("event_type") == "click").select("customer_id", "product_id")
    return insert_ignore(existing, new, ["customer_id", "product_id"], ["added_at"])


def build_carts(keys: DataFrame, customers: DataFrame, products: DataFrame, as_of: str, seed: int = 42):
    """Carts (20% guests, six-way status mix) created up to 60 days back (whole
    microseconds), with 1-4 skewed items each (B04, B03); a product drawn twice for one cart
    is inserted once, the first draw winning (B07 insert-ignore)."""
    cb = customers.agg(F.min("id").alias("c_lo"), F.count(F.lit(1)).alias("c_n"))
    pb = products.agg(F.min("id").alias("p_lo"), F.count(F.lit(1)).alias("p_n"))
    c_lo, c_n = cb.select("c_lo").scalar(), cb.select("c_n").scalar()   # scalar subqueries (J05)
    p_lo, p_n = pb.select("p_lo").scalar(), pb.select("p_n").scalar()
    g = F.col("g")
    micros = F.floor(uniform(seed, 40, g) * (60 * 86400 * 1_000_000.0)).cast("decimal(18,0)")
    created = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(secs=(micros / 1_000_000).cast("decimal(18,6)"))
    carts = keys.select(
        g.alias("id"),
        F.when(uniform(seed, 41, g) < 0.8, c_lo + F.floor(uniform(seed, 42, g) * c_n)).cast("bigint").alias("customer_id"),
        pick(F.floor(uniform(seed, 43, g) * 6), CART_STATUSES).alias("status"), created.alias("created_at"))
    items = (fan_out(carts.select(F.col("id").alias("cart_id"), "created_at"),
                     1 + F.floor(uniform(seed, 44, "cart_id") * 4), "item")
             .select("cart_id", "item", skewed_key(uniform(seed, 45, "cart_id", "item"), p_lo, p_n, 2.0)
                     .alias("product_id"), (1 + F.floor(uniform(seed, 46, "cart_id", "item") * 3)).cast("int")
                     .alias("quantity"), F.col("created_at").alias("added_at")))
    kept = insert_ignore(items.filter(F.lit(False)), items, ["cart_id", "product_id"], ["added_at", "item"])
    return carts, kept.drop("item")


def _carts_sql(seed: int = 42) -> str:
    u = lambda draw, *k: uniform_sql(seed, draw, *k)
    return f"""pb AS (SELECT min(id) AS lo, count(*) AS n FROM products_v),
carts AS (SELECT o_orderkey AS id,
                 TIMESTAMP '{BUILD_CARTS_AS_OF}' - to_microseconds(CAST(floor({u(40, "o_orderkey")} * 5184000000000.0) AS BIGINT))
                   AS created_at
          FROM orders),
it AS (SELECT id AS cart_id, created_at, unnest(generate_series(1, CAST(1 + floor({u(44, "id")} * 4) AS BIGINT))) AS item
       FROM carts),
items AS (SELECT cart_id, item, {skewed_key_sql(u(45, "cart_id", "item"), "pb.lo", "pb.n", 2.0)} AS product_id,
                 CAST(1 + floor({u(46, "cart_id", "item")} * 3) AS INT) AS quantity, created_at AS added_at
          FROM it, pb)"""


BUILD_CARTS_AS_OF = "2024-01-31 00:00:00"


@register("carts_build", adapters=("products_v",), oracle=f"""WITH {_carts_sql()}
SELECT cart_id, product_id, arg_min(quantity, item) AS quantity, arg_min(added_at, item) AS added_at
FROM items GROUP BY 1, 2""")
def q_carts_build(spark, d):
    t = Tables(spark, d)
    _, items = build_carts(t.orders.select(F.col("o_orderkey").alias("g")), t.customers_v, t.products_v,
                           BUILD_CARTS_AS_OF)
    return items


@register("cart_rows_build", adapters=("customers_v", "products_v"), oracle=f"""WITH {_carts_sql()},
cb AS (SELECT min(id) AS lo, count(*) AS n FROM customers_v)
SELECT id, CASE WHEN {uniform_sql(42, 41, "id")} < 0.8 THEN CAST(cb.lo + floor({uniform_sql(42, 42, "id")} * cb.n) AS BIGINT) END AS customer_id,
       {_arr_sql(CART_STATUSES)}[1 + CAST(floor({uniform_sql(42, 43, "id")} * 6) AS INT)] AS status, created_at
FROM carts, cb""")
def q_cart_rows_build(spark, d):
    """The carts themselves: guests, the status mix and their times."""
    t = Tables(spark, d)
    carts, _ = build_carts(t.orders.select(F.col("o_orderkey").alias("g")), t.customers_v, t.products_v, BUILD_CARTS_AS_OF)
    return carts


# ---- W04 latest open cart -----------------------------------------------------------------------------

@register("latest_open_cart", oracle="""
WITH e AS (SELECT * FROM events WHERE ts <= TIMESTAMP '""" + CART_AS_OF + """'),
g AS (SELECT user_id, date_trunc('day', ts) AS day, min(event_id) AS id, max(ts) AS updated_at,
             count(*) FILTER (WHERE event_type = 'purchase') AS buys, count(*) FILTER (WHERE event_type = 'error') AS errs
      FROM e GROUP BY 1, 2)
SELECT user_id AS customer_id, arg_max(id, (updated_at, id)) AS id, max(updated_at) AS updated_at FROM g
WHERE buys = 0 AND errs = 0 AND user_id % 5 <> 0 GROUP BY 1""")
def q_latest_open_cart(spark, d):
    """Each customer's latest open cart as a max_by aggregate."""
    t = Tables(spark, d)
    carts, _ = carts_from_events(t.events, n_products(t), CART_AS_OF)
    return latest_per_key(carts.filter((F.col("status") == "open") & F.col("customer_id").isNotNull()),
                          ["customer_id"], ["updated_at", "id"], ["id", "updated_at"])


# ---- B18 / F10 audit rows with JSON details ---------------------------------------------------------------

def build_audit(events: DataFrame) -> DataFrame:
    """An audit row per event with JSON details (``to_json(struct)``)."""
    details = F.to_json(F.struct(
        F.concat(F.lit("10."), (F.col("user_id") % 255).cast("string"), F.lit("."),
                 (F.col("event_id") % 255).cast("string"), F.lit(".1")).alias("ip"),
        F.lit("shop-client").alias("user_agent")))
    return events.select(F.col("event_id").alias("id"), F.col("ts").alias("occurred_at"),
                         F.concat(F.lit("customer:"), F.col("user_id").cast("string")).alias("actor"),
                         F.col("event_type").alias("action"), details.alias("details"), "props")


@register("audit_json", oracle="""
SELECT event_id AS id, ts AS occurred_at, 'customer:' || CAST(user_id AS VARCHAR) AS actor, event_type AS action,
       '{"ip":"10.' || CAST(user_id % 255 AS VARCHAR) || '.' || CAST(event_id % 255 AS VARCHAR) || '.1","user_agent":"shop-client"}' AS details,
       '10.' || CAST(user_id % 255 AS VARCHAR) || '.' || CAST(event_id % 255 AS VARCHAR) || '.1' AS ip,
       CAST(json_extract(props, '$.k') AS INT) AS k
FROM events""")
def q_audit_json(spark, d):
    """JSON built with to_json(struct) and read back with get_json_object / from_json."""
    a = build_audit(Tables(spark, d).events)
    return a.select("id", "occurred_at", "actor", "action", "details",
                    F.get_json_object("details", "$.ip").alias("ip"),
                    F.from_json("props", "k int").getField("k").alias("k"))


# ---- P05 / P06 classifiers ----------------------------------------------------------------------------

_CODES = ("55P03", "57014", "40P01", "40001", "25P03", "08006", "57P01", "XX000")


@register("error_classes", oracle="""
WITH c AS (SELECT CASE WHEN event_id % 9 = 8 THEN NULL ELSE """ + _arr_sql(_CODES) + """[1 + event_id % 9] END AS code,
                  [1205, 1213, 3024, 1317, 1040, 1045, 1146, 3819, 2013, 9999][1 + event_id % 10] AS mysql_code
           FROM events WHERE event_type = 'error')
SELECT CASE code WHEN '55P03' THEN 'lock_timeout' WHEN '57014' THEN 'canceled' WHEN '40P01' THEN 'deadlock'
                 WHEN '40001' THEN 'serialization' WHEN '25P03' THEN 'idle_in_tx_timeout'
                 ELSE CASE WHEN code IS NULL OR code LIKE '08%' OR code IN ('57P01', '57P02', '57P03') THEN 'connection'
                      ELSE 'other' END END AS pg_result,
       CASE mysql_code WHEN 1205 THEN 'lock_timeout' WHEN 1213 THEN 'deadlock' WHEN 3024 THEN 'query_timeout'
                       WHEN 1317 THEN 'killed' WHEN 1040 THEN 'too_many_connections' WHEN 1045 THEN 'denied'
                       WHEN 1146 THEN 'missing_table' WHEN 3819 THEN 'check_violation' WHEN 2013 THEN 'connection'
                       ELSE 'other' END AS mysql_result,
       count(*) AS errors
FROM c GROUP BY 1, 2""")
def q_error_classes(spark, d):
    """Database error codes (derived from the error events) classified per dialect."""
    e = Tables(spark, d).events.filter(F.col("event_type") == "error")
    code = F.when(F.col("event_id") % 9 == 8, F.lit(None).cast("string")).otherwise(pick("event_id", _CODES + ("",)))
    mysql = pick("event_id", [1205, 1213, 3024, 1317, 1040, 1045, 1146, 3819, 2013, 9999])
    c = e.select(code.alias("code"), mysql.alias("mysql_code"))
    return c.groupBy(classify_error("code", "pg").alias("pg_result"),
                     classify_error("mysql_code", "mysql").alias("mysql_result")).agg(F.count(F.lit(1)).alias("errors"))


@register("outcome_classes", adapters=("requests_v",), oracle="""
SELECT tx, CASE WHEN result = 'ok' THEN 'ok' WHEN result = 'out_of_stock' THEN 'business' ELSE 'error' END AS class,
       count(*) AS requests FROM requests_v GROUP BY 1, 2""")
def q_outcome_classes(spark, d):
    """Ok / business outcome / error per transaction."""
    r = Tables(spark, d).requests_v
    return r.groupBy("tx", outcome_class("result").alias("class")).agg(F.count(F.lit(1)).alias("requests"))


# ---- M10 replace one period; T04 clustered write -----------------------------------------------------------

def replace_period(rows: DataFrame, path: str, period_col: str = "period") -> None:
    """Rewrite only the periods present in ``rows`` (dynamic partition overwrite)."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period_col).parquet(path))


@register("leaderboard_periods", adapters=("money_events_v",), oracle="""
WITH p AS (SELECT CAST(date_trunc('week', created_at) AS DATE) AS period, player_id,
                  CAST(round(-sum(amount)) AS BIGINT) AS points
           FROM money_events_v WHERE type = 'stake' GROUP BY 1, 2)
SELECT CAST(period AS VARCHAR) AS period, player_id,
       CASE WHEN period = DATE '2024-01-15' THEN points * 2 ELSE points END AS points FROM p""")
def q_leaderboard_periods(spark, d):
    """Weekly points written per period, then one week recomputed and replaced alone."""
    m = Tables(spark, d).money_events_v.filter(F.col("type") == "stake")
    week = F.date_sub(F.to_date("created_at"), F.weekday("created_at")).cast("string")
    pts = m.groupBy(week.alias("period"), "player_id").agg(F.round(-F.sum("amount")).cast("bigint").alias("points"))
    path = scratch_path(spark, "leaderboard")
    replace_period(pts, path)
    replace_period(pts.filter(F.col("period") == "2024-01-15").withColumn("points", F.col("points") * 2), path)
    return spark.read.parquet(path).select(F.col("period").cast("string").alias("period"), "player_id", "points")


def write_clustered(df: DataFrame, path: str, cols: list[str]) -> None:
    """Rows range-partitioned and sorted by ``cols`` so Parquet min/max statistics skip
    files and row groups for range predicates (BRIN-like)."""
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


@register("clustered_events", oracle="""
SELECT count(*) AS rows, min(ts) AS first_ts, max(ts) AS last_ts FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'""")
def q_clustered_events(spark, d):
    """Events written clustered by time, then a one-day range read (pushed to the scan)."""
    path = scratch_path(spark, "events-clustered")
    write_clustered(Tables(spark, d).events, path, ["ts", "event_id"])
    day = spark.read.parquet(path).filter((F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"))
                                          & (F.col("ts") < F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")))
    return day.agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
