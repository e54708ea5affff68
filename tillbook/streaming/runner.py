"""Stream sources and sinks (S11, S12) and a drain helper for availableNow runs.

* ``stream_table``: a Structured Streaming file source with the declared schema.
* ``drain_upsert``: ``foreachBatch`` into a ``versions.UpsertTable``: a delta per micro-batch (a replay
  replaces it), a compacted base, and the newest row per key on read (Parquet has no MERGE).
* ``drain``: run a query with ``trigger(availableNow=True)`` to completion, checkpointing
  in the shared checkpoint folder (never a machine-local path on a cluster).
"""

from __future__ import annotations

import contextlib
import os
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.session import configure, scratch_path
from tillbook.sources.tables import SCHEMAS
from tillbook.sources.versions import UpsertTable, VersionedTable


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A driver table as a stream (one file per trigger), read with its declared schema."""
    configure(spark)
    # The file source watches a directory or a glob; a one-name brace glob selects exactly this table.
    pattern = os.path.join(sf_dir, "{" + name + "}.parquet")
    return (spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(pattern))


def event_time(col: str = "ts") -> F.Column:
    """Watermarks need TIMESTAMP (with zone); the driver tables carry TIMESTAMP_NTZ (UTC session)."""
    return F.col(col).cast("timestamp")


def ntz(c: F.Column) -> F.Column:
    return c.cast("timestamp_ntz")


@contextlib.contextmanager
def _state_partitions(spark: SparkSession) -> Iterator[None]:
    """While a query starts: no more shuffle partitions, and so state stores, than twice the cores. A query keeps the
    number that it starts with, and every one of its micro-batches opens and commits all its stores."""
    key = "spark.sql.shuffle.partitions"
    given, most = spark.conf.get(key), 2 * spark.sparkContext.defaultParallelism
    if int(given) > most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, given)


def drain_append(stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode query to completion into Parquet; return the sink as a batch table."""
    spark = stream.sparkSession
    base = scratch_path(spark, f"streams/{name}")
    with _state_partitions(spark):
        q = (stream.writeStream.format("parquet").outputMode("append")
             .option("path", os.path.join(base, "data")).option("checkpointLocation", os.path.join(base, "_checkpoint"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(os.path.join(base, "data"))


def drain_upsert(stream: DataFrame, name: str, keys: Sequence[str], mode: str = "update") -> DataFrame:
    """Run an update- or complete-mode query through the upsert sink (S12); return the keyed table."""
    spark = stream.sparkSession
    base = scratch_path(spark, f"streams/{name}")
    table = UpsertTable(spark, os.path.join(base, "table"), stream.schema, keys)
    # in complete mode every batch holds the whole result: it replaces the table
    write = table.write if mode == "update" else lambda batch, _: VersionedTable.replace(table, batch)
    with _state_partitions(spark):
        q = (stream.writeStream.outputMode(mode).foreachBatch(write)
             .option("checkpointLocation", os.path.join(base, "_checkpoint"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return table.read() if mode == "update" else VersionedTable.read(table)


def drain_batches(stream: DataFrame, name: str, fn: Callable[[DataFrame, int], DataFrame],
                  schema: T.StructType) -> DataFrame:
    """foreachBatch with a batch job per micro-batch (its output appended per batch id)."""
    spark = stream.sparkSession
    base = scratch_path(spark, f"streams/{name}")
    data = os.path.join(base, "data")

    ran: list[int] = []

    def run(batch: DataFrame, batch_id: int) -> None:
        ran.append(batch_id)
        fn(batch, batch_id).write.mode("overwrite").parquet(os.path.join(data, f"batch={batch_id}"))

    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", os.path.join(base, "_checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if not ran:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(data).drop("batch")
