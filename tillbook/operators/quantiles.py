"""Exact percentiles by distributed rank selection.

An exact percentile of a group needs the values at one or two ranks. ``percentile`` gets them from a map
of all the group's values in one buffer; here no task holds a group. The values are counted once, as
(key, value, count). Each round then cuts every open group's range into ``CELLS`` cells, counts them with a
partial aggregation before the shuffle, and finds the cell with the wanted rank from the running counts
of at most ``CELLS`` rows a group. A rank at the edge of its cell is solved by the cell's least or
largest value; a group with another goes on within that cell alone. A round narrows the range about a
thousandfold, so few are needed whatever the number of values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillbook.session import scratch_path

CELLS = 1024


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float, cells: int = CELLS) -> DataFrame:
    """keys and ``percentile``: the continuous percentile ``q`` (0 to 1) of ``value`` (a double) per group, linearly
    interpolated between neighbouring ranks. Nulls and NaN are left out; a group without values has no row."""
    keys = list(keys)
    spark = df.sparkSession

    def kept(rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"percentile-{name}")
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    v = F.col(value).cast("double")
    counts = kept(df.filter(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "counts")
    at = F.lit(float(q)) * (F.sum("_n") - 1)
    state = kept(counts.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.lit(0).cast("long").alias("_below"),
                                           F.floor(at).alias("_rank"), (at - F.floor(at)).alias("_part")), "state")
    done: list[DataFrame] = []
    state_keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_cell")
    while True:
        s = state.select(*state_keys, "_lo", "_hi", "_below", "_rank", "_part")
        inside = counts.join(s, [*same, F.col("_v") >= F.col("_lo"), F.col("_v") <= F.col("_hi")])
        cell = F.when(F.col("_hi") > F.col("_lo"), F.least(F.lit(cells - 1), F.floor(
            (F.col("_v") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)) * cells))).otherwise(0)
        group = [f"_k{i}" for i in range(len(keys))]
        cellrows = inside.groupBy(*group, "_below", "_rank", "_part", cell.alias("_cell")).agg(
            F.sum("_n").alias("_count"), F.min("_v").alias("_least"), F.max("_v").alias("_most"))
        upto = F.sum("_count").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cellrows = cellrows.withColumn("_before", F.col("_below") + upto - F.col("_count")).withColumn("_next", F.lead("_least").over(w))
        hit = cellrows.filter((F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_count")))

        def at_rank(offset) -> Column:
            """The value at a rank of the cell, where it is known."""
            return (F.when((F.col("_least") == F.col("_most")) | (offset == 0), F.col("_least"))
                    .when(offset == F.col("_count") - 1, F.col("_most")))

        offset = F.col("_rank") - F.col("_before")
        low = at_rank(offset)
        high = F.when(F.col("_part") == 0, low).when(offset + 1 < F.col("_count"), at_rank(offset + 1)).otherwise(F.col("_next"))
        seen, path = Observation(), scratch_path(spark, "percentile-round")
        out = hit.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], F.col("_least").alias("_lo"), F.col("_most").alias("_hi"),
                         F.col("_before").alias("_below"), "_rank", "_part", (low + (high - low) * F.col("_part")).alias("percentile"))
        out.observe(seen, F.count_if(F.col("percentile").isNull()).alias("open")).write.parquet(path)
        rounds = spark.read.schema(out.schema).parquet(path)
        done.append(rounds.filter(F.col("percentile").isNotNull()).select(*keys, "percentile"))
        if not seen.get["open"]:
            break
        state = rounds.filter(F.col("percentile").isNull()).drop("percentile")
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result
