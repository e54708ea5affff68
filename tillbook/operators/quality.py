"""Data-quality rules (D01-D07): the declared constraints Spark does not enforce on Parquet.

Every rule is one aggregation pass (map-side combined); reports carry counts and one sample
key, never the violating rows themselves, so a report stays small however dirty the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _unpivot(one_row: DataFrame, names: Sequence[str], fields: Sequence[str], label: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(n).alias(label), *[F.col(f"{n}__{f}").alias(f) for f in fields]) for n in names])
    return one_row.select(F.inline(arr))


def check_rules(df: DataFrame, rules: Mapping[str, Column], key: str) -> DataFrame:
    """CHECK rules (a null result passes, as in SQL): violations and the smallest violating key."""
    aggs = []
    for name, rule in rules.items():
        bad = ~F.coalesce(rule, F.lit(True))
        aggs += [F.count_if(bad).alias(f"{name}__violations"), F.min(F.when(bad, F.col(key))).alias(f"{name}__sample_key")]
    return _unpivot(df.agg(*aggs), list(rules), ["violations", "sample_key"], "rule")


def domain_rules(df: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside an ENUM / IN list (nulls are not violations)."""
    aggs = []
    for col, dom in domains.items():
        bad = F.col(col).isNotNull() & ~F.col(col).isin(*dom)
        aggs += [F.count_if(bad).alias(f"{col}__violations"), F.min(F.when(bad, F.col(col))).alias(f"{col}__sample_value")]
    return _unpivot(df.agg(*aggs), list(domains), ["violations", "sample_value"], "column")


def unique_rules(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate keys with their row counts (primary key / UNIQUE)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def fk_rules(child: DataFrame, parent: DataFrame, on: Mapping[str, str], name: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent (count and smallest orphan key)."""
    (ck, pk), = on.items()
    orphans = (child.filter(F.col(ck).isNotNull())
               .join(parent.select(F.col(pk).alias("_pk")).distinct(), F.col(ck) == F.col("_pk"), "left_anti"))
    return orphans.agg(F.lit(name).alias("foreign_key"), F.count(F.lit(1)).alias("orphans"),
                       F.min(ck).alias("sample_key"))


def period_rules(df: DataFrame, key: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """``end`` null or after ``start``; periods of a key must not overlap (checked with the
    next period's start, a backwards segmented scan split by day, so a key with very many
    periods is not one task)."""
    from tillbook.operators.windows import segment_bucket, sequence_scan

    d = sequence_scan(df.select(key, start, end), [key], [start, end], segment_bucket(start), lag_cols=[start],
                      prefix_lag="_next_", descending=True).withColumnRenamed(f"_next_{start}", "_next")
    return d.agg(F.count_if(F.col(end).isNotNull() & (F.col(end) <= F.col(start))).alias("bad_periods"),
                 F.count_if(F.col("_next").isNotNull() & (F.col(end).isNull() | (F.col("_next") < F.col(end))))
                 .alias("overlaps"))


def key_headroom(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The largest key against its type limit."""
    return df.agg(F.max(key).alias("max_key")).select(
        "max_key", F.lit(limit).cast("bigint").alias("type_limit"),
        (F.lit(limit) - F.col("max_key")).alias("headroom"),
        F.round(F.col("max_key") / F.lit(limit), 6).alias("used_share"))


def skew_profile(df: DataFrame, key: str, pct: float) -> DataFrame:
    """Share of rows held by the top ``pct`` of keys, without a global sort of the keys.

    Per-key counts are folded into a histogram (count value -> number of keys), which has at
    most about sqrt(2 x rows) entries; the cumulative walk runs on that small table only.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    hist = counts.groupBy("c").agg(F.count(F.lit(1)).alias("keys"))
    totals = hist.agg(F.sum("keys").alias("n_keys"), F.sum(F.col("c") * F.col("keys")).alias("n_rows"))
    w = Window.orderBy(F.col("c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = (hist.withColumn("keys_before", F.coalesce(F.sum("keys").over(w), F.lit(0)))
         .withColumn("n_keys", totals.select("n_keys").scalar())   # one-row totals: scalar subqueries
         .withColumn("n_rows", totals.select("n_rows").scalar())
         .withColumn("k", F.ceil(F.col("n_keys") * F.lit(pct)).cast("bigint"))
         .withColumn("take", F.greatest(F.lit(0), F.least(F.col("keys"), F.col("k") - F.col("keys_before")))))
    return h.groupBy("n_keys", "n_rows", "k").agg(F.sum(F.col("take") * F.col("c")).alias("top_rows")).select(
        F.lit(pct).alias("pct"), F.col("n_keys").alias("keys"), F.col("k").alias("top_keys"),
        F.col("n_rows").alias("rows"), F.col("top_rows").cast("bigint").alias("top_rows"),
        F.round(F.col("top_rows") / F.col("n_rows"), 6).alias("share"))
