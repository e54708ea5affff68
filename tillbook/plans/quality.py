"""Registered data-quality reports over the adapters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillbook.operators.quality import (check_rules, domain_rules, fk_rules, key_headroom, period_rules,
                                        skew_profile, unique_rules)
from tillbook.plans.build import build_price_periods
from tillbook.plans.registry import register
from tillbook.session import ORDERS_AS_OF
from tillbook.sources.adapters import Tables

# Order and player status domains (CHECK / ENUM lists of the reference schemas).
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled", "refunded")
PLAYER_STATUSES = ("active", "self_excluded", "suspended", "closed")


@register("check_rules", adapters=("order_items_v",), oracle="""
SELECT * FROM (VALUES
  ('quantity_positive', (SELECT count(*) FROM order_items_v WHERE NOT coalesce(quantity > 0, true)),
   (SELECT min(order_id) FROM order_items_v WHERE NOT coalesce(quantity > 0, true))),
  ('price_non_negative', (SELECT count(*) FROM order_items_v WHERE NOT coalesce(unit_price >= 0, true)),
   (SELECT min(order_id) FROM order_items_v WHERE NOT coalesce(unit_price >= 0, true))),
  ('line_below_7', (SELECT count(*) FROM order_items_v WHERE NOT coalesce(line < 7, true)),
   (SELECT min(order_id) FROM order_items_v WHERE NOT coalesce(line < 7, true)))
) t(rule, violations, sample_key)""")
def q_check_rules(spark, d):
    items = Tables(spark, d).order_items_v
    return check_rules(items, {"quantity_positive": F.col("quantity") > 0,
                               "price_non_negative": F.col("unit_price") >= 0,
                               "line_below_7": F.col("line") < 7}, "order_id")


@register("domain_rules", adapters=("players_v",), oracle="""
SELECT * FROM (VALUES
  ('status', (SELECT count(*) FROM players_v WHERE status NOT IN ('active','self_excluded','suspended','closed')),
   (SELECT min(status) FROM players_v WHERE status NOT IN ('active','self_excluded','suspended','closed'))),
  ('kyc_status', (SELECT count(*) FROM players_v WHERE kyc_status NOT IN ('verified')),
   (SELECT min(kyc_status) FROM players_v WHERE kyc_status NOT IN ('verified')))
) t("column", violations, sample_value)""")
def q_domain_rules(spark, d):
    p = Tables(spark, d).players_v
    return domain_rules(p, {"status": PLAYER_STATUSES, "kyc_status": ("verified",)})


@register("unique_rules", adapters=("order_items_v",), oracle="""
SELECT order_id, line, count(*) AS rows FROM order_items_v GROUP BY 1, 2 HAVING count(*) > 1""")
def q_unique_rules(spark, d):
    return unique_rules(Tables(spark, d).order_items_v, ["order_id", "line"])


@register("fk_rules", adapters=("orders_v", "customers_v"), oracle="""
SELECT 'orders.customer_id' AS foreign_key, count(*) AS orphans, min(customer_id) AS sample_key
FROM orders_v o WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customers_v c WHERE c.id = o.customer_id)""")
def q_fk_rules(spark, d):
    t = Tables(spark, d)
    return fk_rules(t.orders_v, t.customers_v, {"customer_id": "id"}, "orders.customer_id")


@register("period_rules", adapters=("products_v",), oracle="""
WITH periods AS (
  SELECT p.id AS product_id,
         TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 1 YEAR + to_months(CAST((k - 1) * 4 AS INT)) AS valid_from,
         CASE WHEN k < 3 THEN TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 1 YEAR + to_months(CAST(k * 4 AS INT)) END AS valid_to
  FROM products_v p, range(1, 4) r(k)),
n AS (SELECT *, lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from, valid_to) AS nxt FROM periods)
SELECT count(*) FILTER (WHERE valid_to IS NOT NULL AND valid_to <= valid_from) AS bad_periods,
       count(*) FILTER (WHERE nxt IS NOT NULL AND (valid_to IS NULL OR nxt < valid_to)) AS overlaps FROM n""")
def q_period_rules(spark, d):
    t = Tables(spark, d)
    return period_rules(build_price_periods(t.products_v, ORDERS_AS_OF), "product_id")


@register("key_headroom", adapters=("orders_v",), oracle="""
SELECT max(id) AS max_key, CAST(2147483647 AS BIGINT) AS type_limit, 2147483647 - max(id) AS headroom,
       round(max(id) / 2147483647, 6) AS used_share FROM orders_v""")
def q_key_headroom(spark, d):
    return key_headroom(Tables(spark, d).orders_v, "id", 2147483647)


@register("skew_profile", adapters=("order_items_v",), oracle="""
WITH c AS (SELECT product_id, count(*) AS c FROM order_items_v GROUP BY 1),
r AS (SELECT c, row_number() OVER (ORDER BY c DESC, product_id) AS rn, count(*) OVER () AS n_keys,
             sum(c) OVER () AS n_rows FROM c)
SELECT CAST(0.01 AS DOUBLE) AS pct, max(n_keys) AS keys, CAST(ceil(max(n_keys) * 0.01) AS BIGINT) AS top_keys,
       CAST(max(n_rows) AS BIGINT) AS rows,
       CAST(sum(c) FILTER (WHERE rn <= ceil(n_keys * 0.01)) AS BIGINT) AS top_rows,
       round(sum(c) FILTER (WHERE rn <= ceil(n_keys * 0.01)) / max(n_rows), 6) AS share FROM r""")
def q_skew_profile(spark, d):
    return skew_profile(Tables(spark, d).order_items_v, "product_id", 0.01)
