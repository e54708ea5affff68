"""Deterministic dataset builders (B01-B27) as DataFrame jobs.

Random draws are hashes of ``(seed, draw, id)`` (``functions.uniform``), so a rerun gives the
same rows on any cluster size. Fan-outs use ``explode(sequence(..))`` instead of theta joins
(J06), and literal lists are arrays, never cartesian joins with a table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.functions import skewed_key, ts_lit, uniform


def rows(spark: SparkSession, n: int, scale: float = 1.0, name: str = "g") -> DataFrame:
    """Ids 1..n x scale (``generate_series``), generated in parallel on the executors."""
    return spark.range(1, int(n * scale) + 1).withColumnRenamed("id", name)


def fan_out(df: DataFrame, n_expr: Column, name: str = "k") -> DataFrame:
    """1..n child rows per parent (``explode(sequence)``, no nested-loop join)."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), n_expr.cast("int"))))


def cross_list(df: DataFrame, values: Sequence[dict], name: str = "item") -> DataFrame:
    """Parent x a literal list of structs, as an exploded array (no cartesian join)."""
    arr = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in row.items()]) for row in values])
    return df.withColumn(name, F.explode(arr)).select("*", f"{name}.*").drop(name)


def build_price_periods(products: DataFrame, as_of: str) -> DataFrame:
    """Three consecutive price periods per product (-20%, -10%, list price), last one open."""
    start = ts_lit(as_of) - F.make_ym_interval(F.lit(1), F.lit(0))
    k = F.col("k")
    return (fan_out(products.select(F.col("id").alias("product_id"), "price"), F.lit(3))
            .select(F.col("product_id"),
                    F.round(F.col("price") * (F.lit(0.8).cast("decimal(2,1)") + F.lit(0.1).cast("decimal(2,1)") * k), 2)
                    .cast("decimal(10,2)").alias("price"),
                    (start + F.make_ym_interval(F.lit(0), (k - 1) * 4)).alias("valid_from"),
                    F.when(k < 3, start + F.make_ym_interval(F.lit(0), k * 4)).alias("valid_to")))


# ---- B12 / B13: orders with ids in time order, lines, totals --------------------------------------

def sequence_ids(df: DataFrame, order: Sequence[str], name: str = "id", partitions: int | None = None) -> DataFrame:
    """Consecutive ids 1..n in ``order`` without a global sort on one task (two passes, like
    ``zipWithIndex``): range-partition and sort, count rows per partition, prefix-sum the
    (few) partition counts, then number rows inside each partition. The sorted input is
    checkpointed first so a recomputation after an executor loss numbers the same rows."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_df = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                 .withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
                 .checkpoint())
    counts = sorted_df.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition
    offsets = counts.select("_p", "_m0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (sorted_df.join(F.broadcast(offsets), "_p")   # bounded: one row per partition
            .withColumn(name, F.col("_off") + (F.col("_m") - F.col("_m0")) + 1).drop("_p", "_m", "_m0", "_off"))


def build_orders(keys: DataFrame, customers: DataFrame, as_of: str, seed: int = 42) -> DataFrame:
    """One order per source key: age skewed to recent (u^1.3 x 365 days, whole seconds),
    customer skewed (B03, k = 1.5), status from the age ladder; ids then follow created_at
    (``sequence_ids``). The customer bounds are scalar subqueries (J05): one value each,
    computed once and shipped to the tasks as literals."""
    bounds = customers.agg(F.min("id").alias("lo"), F.count(F.lit(1)).alias("n"))
    lo, n = bounds.select("lo").scalar(), bounds.select("n").scalar()
    g = F.col("g")
    age_s = F.floor(F.pow(uniform(seed, 1, g), F.lit(1.3)) * F.lit(365 * 86400.0))
    u_status = uniform(seed, 3, g)
    status = (F.when(age_s < 86400, F.when(u_status < 0.5, "pending").otherwise("paid"))
              .when(age_s < 5 * 86400, F.when(u_status < 1 / 3, "paid").otherwise("shipped"))
              .when(uniform(seed, 4, g) < 0.03, "cancelled").when(uniform(seed, 5, g) < 0.02, "refunded")
              .otherwise("delivered"))
    created = ts_lit(as_of) - F.make_dt_interval(secs=age_s.cast("decimal(18,6)"))
    o = (keys.select("g", skewed_key(uniform(seed, 2, g), lo, n, 1.5).alias("customer_id"),
                     status.alias("status"), created.alias("created_at")))
    return sequence_ids(with_updated_at(o), ["created_at", "g"])


def build_order_lines(orders: DataFrame, products: DataFrame, seed: int = 42) -> DataFrame:
    """1-4 lines per order (B04), products skewed (k = 3, about 21% of lines on the top 1%),
    joined to the catalogue by the computed key (J07)."""
    bounds = products.agg(F.min("id").alias("lo"), F.count(F.lit(1)).alias("n"))
    lo, n = bounds.select("lo").scalar(), bounds.select("n").scalar()
    lines = fan_out(orders.select(F.col("id").alias("order_id")), 1 + F.floor(uniform(seed, 10, "order_id") * 4), "line")
    picked = lines.select(
        "order_id", "line", skewed_key(uniform(seed, 11, "order_id", "line"), lo, n, 3.0).alias("product_id"),
        (1 + F.floor(F.pow(uniform(seed, 12, "order_id", "line"), F.lit(3.0)) * 4)).cast("int").alias("quantity"))
    return picked.join(products.select(F.col("id").alias("product_id"), F.col("price").alias("unit_price")),
                       "product_id")


def order_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order totals rewritten from their lines (orders without lines keep 0)."""
    from tillbook.operators.joins import update_from

    t = lines.groupBy(F.col("order_id").alias("id")).agg(
        F.sum(F.col("quantity") * F.col("unit_price")).cast("decimal(12,2)").alias("total_amount"))
    return update_from(orders.withColumn("total_amount", F.lit(0).cast("decimal(12,2)")), t, ["id"], ["total_amount"])


# ---- B14-B17: documents derived from orders (pure arithmetic, exact oracle) ---------------------------

# The status ladder of an order (step, from, to).
STATUS_STEPS = ((0, None, "pending"), (1, "pending", "paid"), (2, "paid", "shipped"), (3, "shipped", "delivered"))
# Payment methods picked by id modulo, refund reasons, shipment event offsets (hours).
PAYMENT_METHODS = ("card", "card", "card", "paypal", "bank_transfer", "gift_card")
REFUND_REASONS = ("damaged", "wrong item", "changed mind", "late delivery")
SHIPMENT_EVENTS = (("label_created", "warehouse", -12), ("picked_up", "warehouse", 0), ("in_transit", "hub", 24),
                   ("delivered", "customer", 48))


def with_updated_at(orders: DataFrame) -> DataFrame:
    """updated_at of a generated order: created + 0 / 10 min / 1 day / 4 days by status."""
    step = (F.when(F.col("status") == "pending", F.make_dt_interval())
            .when(F.col("status") == "paid", F.make_dt_interval(mins=F.lit(10)))
            .when(F.col("status") == "shipped", F.make_dt_interval(days=F.lit(1)))
            .otherwise(F.make_dt_interval(days=F.lit(4))))
    return orders.withColumn("updated_at", F.col("created_at") + step)


def expand_status_history(orders: DataFrame) -> DataFrame:
    """The statuses an order passed, spread evenly over its life; cancelled / refunded get
    their final transition at ``updated_at``. One pass: each order explodes its own list."""
    life = F.col("updated_at") - F.col("created_at")
    ladder = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(a).cast("string").alias("from_status"),
                                F.lit(b).alias("to_status"), (F.col("created_at") + life * F.lit(s) / 3).alias("changed_at"))
                       for s, a, b in STATUS_STEPS])
    last = (F.when(F.col("status") == "pending", 0).when(F.col("status") == "paid", 1)
            .when(F.col("status") == "shipped", 2).when(F.col("status").isin("delivered", "refunded"), 3).otherwise(0))
    passed = F.filter(ladder, lambda x: x["step"] <= last)
    final = F.array(F.struct(F.lit(len(STATUS_STEPS)).alias("step"),
                             F.when(F.col("status") == "cancelled", "pending").otherwise("delivered").alias("from_status"),
                             F.col("status").alias("to_status"), F.col("updated_at").alias("changed_at")))
    moves = F.when(F.col("status").isin("cancelled", "refunded"), F.concat(passed, final)).otherwise(passed)
    return (orders.select(F.col("id").alias("order_id"), F.explode(moves).alias("m"))
            .select("order_id", "m.from_status", "m.to_status", "m.changed_at"))


def derive_payments(orders: DataFrame) -> DataFrame:
    """One payment per order: method by id modulo, status from the order, md5 provider ref."""
    st = F.col("status")
    return orders.select(
        F.col("id").alias("order_id"), F.col("total_amount").alias("amount"),
        F.element_at(F.array(*[F.lit(m) for m in PAYMENT_METHODS]), (1 + F.col("id") % 6).cast("int")).alias("method"),
        F.when(st == "pending", "pending").when(st == "cancelled", "failed").when(st == "refunded", "refunded")
        .otherwise("captured").alias("status"),
        F.concat(F.lit("PSP-"), F.substring(F.md5(F.col("id").cast("string")), 1, 16)).alias("provider_ref"),
        "created_at", "updated_at")


def derive_invoices(orders: DataFrame) -> DataFrame:
    """Invoice number ``INV-YYYY-000000000`` for paid and later orders, 5 minutes after."""
    return orders.filter(F.col("status").isin("paid", "shipped", "delivered", "refunded")).select(
        F.col("id").alias("order_id"),
        F.concat(F.lit("INV-"), F.date_format("created_at", "yyyy"), F.lit("-"),
                 F.lpad(F.col("id").cast("string"), 9, "0")).alias("number"),
        (F.col("created_at") + F.make_dt_interval(mins=F.lit(5))).alias("issued_at"))


def coupon_usage(orders: DataFrame, coupons: int = 500) -> DataFrame:
    """Every 10th order uses coupon ``1 + id mod coupons``; used_count per coupon."""
    return (orders.filter(F.col("id") % 10 == 0).select((1 + F.col("id") % coupons).cast("int").alias("coupon_id"))
            .groupBy("coupon_id").agg(F.count(F.lit(1)).alias("used_count")))


def build_shipments(orders: DataFrame, warehouses: int = 5, carriers: int = 6):
    """Shipments of shipped / delivered / refunded orders and their 3-4 events."""
    o = orders.filter(F.col("status").isin("shipped", "delivered", "refunded"))
    ship = o.select(
        F.col("id").alias("order_id"), (1 + F.col("id") % warehouses).cast("int").alias("warehouse_id"),
        (1 + F.col("id") % carriers).cast("int").alias("carrier_id"),
        F.concat(F.lit("TRK"), F.lpad(F.col("id").cast("string"), 12, "0")).alias("tracking_number"),
        F.when(F.col("status") == "shipped", "in_transit").when(F.col("status") == "refunded", "returned")
        .otherwise("delivered").alias("status"),
        (F.col("created_at") + F.make_dt_interval(days=F.lit(1))).alias("shipped_at"),
        F.when(F.col("status").isin("delivered", "refunded"), F.col("created_at") + F.make_dt_interval(days=F.lit(3)))
        .alias("delivered_at"))
    ev = F.array(*[F.struct(F.lit(e).alias("event"), F.lit(loc).alias("location"), F.lit(h).alias("hours"))
                   for e, loc, h in SHIPMENT_EVENTS])
    events = (ship.select("order_id", "status", "shipped_at", F.explode(ev).alias("e"))
              .filter((F.col("e.event") != "delivered") | F.col("status").isin("delivered", "returned"))
              .select("order_id", "e.event", "e.location",
                      (F.col("shipped_at") + F.make_dt_interval(hours=F.col("e.hours"))).alias("created_at")))
    return ship, events


def derive_sales_ledger(lines: DataFrame, orders: DataFrame, warehouses: int = 5) -> DataFrame:
    """A sale movement per order line of orders that were not cancelled."""
    o = orders.filter(F.col("status") != "cancelled").select(F.col("id").alias("order_id"), "created_at")
    return lines.join(o, "order_id").select(
        (1 + F.col("order_id") % warehouses).cast("int").alias("warehouse_id"), "product_id",
        (-F.col("quantity")).alias("quantity"), F.lit("sale").alias("reason"), "order_id", "created_at")


# ---- B19 / B24: sportsbook fixtures from id arithmetic ------------------------------------------------

def build_matches(ids: DataFrame, as_of_hour: str) -> DataFrame:
    """Settled matches with ids 1..n: competition, home and away teams (never equal),
    15-minute kick-off slots spread over the past 29 days; scores from hashed draws."""
    n = F.col("n")
    comp = 1 + n % 12
    home_ix = (n * 7) % 20
    starts = (ts_lit(as_of_hour) - F.make_dt_interval(days=F.lit(1))
              - F.make_dt_interval(mins=((n * 7919) % 2784 * 15).cast("int")))
    return ids.select(
        n.alias("id"), comp.cast("int").alias("competition_id"),
        ((comp - 1) * 20 + 1 + home_ix).cast("int").alias("home_team_id"),
        ((comp - 1) * 20 + 1 + (home_ix + 1 + n % 19) % 20).cast("int").alias("away_team_id"),
        starts.alias("starts_at"), F.lit("settled").alias("status"),
        F.floor(F.pow(uniform(7, 1, n), F.lit(1.7)) * 6).cast("int").alias("home_score"),
        F.floor(F.pow(uniform(7, 2, n), F.lit(2.0)) * 5).cast("int").alias("away_score"),
        starts.alias("kicked_off_at"), (starts + F.make_dt_interval(mins=F.lit(110))).alias("finished_at"),
        (starts + F.make_dt_interval(mins=F.lit(115))).alias("settled_at"))


def build_players(ids: DataFrame) -> DataFrame:
    """Players with status, KYC, VIP level and limits by id modulo."""
    n = F.col("n")
    vip = F.when(n % 200 == 0, 3).when(n % 40 == 0, 2).when(n % 10 == 0, 1).otherwise(0)
    return ids.select(
        n.alias("id"), F.concat(F.lit("player"), n.cast("string")).alias("username"),
        F.concat(F.lit("player"), n.cast("string"), F.lit("@example.com")).alias("email"),
        F.when(n % 101 == 0, "self_excluded").when(n % 97 == 0, "closed").when(n % 89 == 0, "suspended")
        .otherwise("active").alias("status"),
        F.when(n % 10 == 0, "pending").otherwise("verified").alias("kyc_status"), vip.cast("int").alias("vip_level"),
        (n % 3 == 0).alias("marketing_opt_in"),
        F.when(vip == 3, 10000).when(vip == 2, 2500).when(vip == 1, 1000).otherwise(500).cast("decimal(12,2)")
        .alias("max_stake"),
        F.when(n % 7 == 0, F.lit(1000)).cast("decimal(12,2)").alias("daily_deposit_limit"),
        F.when(n % 11 == 0, F.lit(300)).cast("decimal(12,2)").alias("daily_loss_limit"))


def build_ledger(players: DataFrame, bets: DataFrame) -> DataFrame:
    """Ledger-consistent money per player: a first deposit covering all stakes plus
    50..500, stakes, wins, and a withdrawal of half the balance when it exceeds 300."""
    per = bets.groupBy("player_id").agg(
        F.sum("stake").alias("stakes"), F.sum(F.when(F.col("status") == "won", F.col("payout")).otherwise(0)).alias("wins"))
    p = players.select(F.col("id").alias("player_id")).join(per, "player_id", "left")
    deposit = (F.coalesce("stakes", F.lit(0)) + 50 + (F.col("player_id") * 7919) % 451).cast("decimal(14,2)")
    bal = deposit - F.coalesce("stakes", F.lit(0)) + F.coalesce("wins", F.lit(0))
    withdrawal = F.when(bal > 300, F.round(bal / 2, 2)).otherwise(F.lit(0)).cast("decimal(14,2)")
    return p.select("player_id", deposit.alias("deposit"),
                    F.coalesce("stakes", F.lit(0)).cast("decimal(14,2)").alias("stakes"),
                    F.coalesce("wins", F.lit(0)).cast("decimal(14,2)").alias("wins"), withdrawal.alias("withdrawal"),
                    (bal - withdrawal).cast("decimal(14,2)").alias("balance"))
