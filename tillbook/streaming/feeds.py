"""Feeds of several files that arrive out of order, and the stream that reads them.

``write_feed`` lays a table out as a feed would deliver it: every row arrives up to ``late_hours``
after its time (a hash of its id decides how late), the files follow the arrivals, and a heartbeat
comes last. Neighbouring files therefore overlap in time. ``read_feed`` streams the files in
the order of their arrival, one a trigger, with a watermark that allows for the delay, so no row is
late for good. The heartbeat carries the time up to which the feed is complete and nothing else:
it moves the watermark, so that operators in append mode give out what they still hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.session import configure, scratch_path
from tillbook.streaming.runner import event_time

FILES = 4
FILE_ROWS = 1_000_000  # a feed of more rows has more files
LATE_HOURS = 24
END_OF_FEED = "2100-01-01 00:00:00"


def write_feed(df: DataFrame, name: str, ts: str, row_id: str, files: int = FILES, late_hours: int = LATE_HOURS,
               complete_to: str = END_OF_FEED) -> str:
    """The rows of ``df`` as feed files in arrival order, then the heartbeat; returns the folder.

    One job deals the rows into a staged folder per file, all in parallel, so that ``df`` is not worked out again for
    every file; then each file is written from its own folder.
    ``complete_to`` is the time that the watermark reaches in the end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"feeds/{name}")
    late_us = late_hours * 3_600_000_000
    arrival = F.unix_micros(event_time(ts)) + F.pmod(F.xxhash64(row_id), F.lit(late_us))
    first, last, rows = df.agg(F.min(arrival), F.max(arrival), F.count(F.lit(1))).first()
    files = max(files, -(-rows // FILE_ROWS))
    width = 1 if first is None else (last - first) // files + 1
    staged = scratch_path(spark, f"feeds/{name}-staged")
    part = T.StructField("_file", T.IntegerType())
    df.withColumn(part.name, F.floor((arrival - F.lit(first)) / F.lit(width)).cast("int")).where("_file IS NOT NULL") \
        .repartition(files, part.name).write.partitionBy(part.name).parquet(staged)
    dealt = spark.read.schema(T.StructType([*df.schema.fields, part])).parquet(staged)
    for i in range(files):  # one job and one task a file, so that the files' times follow the arrivals
        dealt.where(F.col(part.name) == i).drop(part.name).coalesce(1).write.mode("append").parquet(path)
    beat = F.lit(complete_to).cast("timestamp") + F.make_dt_interval(hours=F.lit(late_hours), mins=F.lit(1))
    spark.range(1).select(*[(beat if f.name == ts else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]) \
        .write.mode("append").parquet(path)
    return path


def read_feed(spark: SparkSession, path: str, schema: T.StructType, ts: str, late_hours: int = LATE_HOURS,
              complete_to: str = END_OF_FEED) -> DataFrame:
    """The feed as a stream with its event time ``_et`` watermarked, up to ``complete_to`` and so without the heartbeat.

    Spark pushes a filter below the watermark unless it reads the event time, and the heartbeat would be gone before it
    has moved the watermark. So the condition that drops it is on the event time, and every column is
    read through a place that depends on it (always the first), which holds later filters above it as well.
    """
    configure(spark)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    s = s.withColumn("_et", event_time(ts)).withWatermark("_et", f"{late_hours} hours 1 minute")
    s = s.filter(F.col("_et") <= F.lit(complete_to).cast("timestamp"))
    first = F.col("_et").isNull().cast("int")
    return s.select(*[F.get(F.array(c), first).alias(c) for c in schema.names], "_et")


def feed(df: DataFrame, name: str, ts: str, row_id: str, files: int = FILES, late_hours: int = LATE_HOURS,
         complete_to: str = END_OF_FEED) -> DataFrame:
    """``df`` written as a feed and read as a stream."""
    path = write_feed(df, name, ts, row_id, files, late_hours, complete_to)
    return read_feed(df.sparkSession, path, df.schema, ts, late_hours, complete_to)
