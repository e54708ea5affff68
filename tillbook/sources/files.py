"""File sources and sinks (S02-S10): JSON-lines outage log, server and audit log parsing,
monthly-partitioned writes and their partition calendar, chunked export, snapshots,
schema evolution. Every path is a folder in the shared checkpoint location or a caller's
table path; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.operators.quantiles import exact_percentile
from tillbook.session import scratch_path
from tillbook.sources.versions import pinned

# ---- S02 / S03 outage log (JSON lines) ------------------------------------------------------------

OUTAGE_RECORD = T.StructType([
    T.StructField("target", T.StringType()), T.StructField("start", T.TimestampNTZType()),
    T.StructField("end", T.TimestampNTZType()), T.StructField("duration_s", T.DoubleType()),
    T.StructField("last_ok", T.TimestampNTZType()), T.StructField("failed_checks", T.LongType()),
    T.StructField("error", T.StringType())])
_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_outages(outages: DataFrame, path: str) -> None:
    """Append closed outages as JSON lines (ISO times, one record per line)."""
    (outages.filter(F.col("end").isNotNull()).select(*[f.name for f in OUTAGE_RECORD.fields])
     .write.mode("append").option("timestampNTZFormat", _TS_FORMAT).json(path))


def read_outages(spark: SparkSession, path: str, last: int = 20):
    """The last ``last`` outages (numbered in time order) and the total downtime.

    The numbering needs only the rank among the last ``last`` records plus the total count,
    so no global window runs over the whole log.
    """
    log = spark.read.schema(OUTAGE_RECORD).option("timestampNTZFormat", _TS_FORMAT).json(path)
    total = log.agg(F.count(F.lit(1)).alias("outages"), F.round(F.sum("duration_s"), 3).alias("downtime_s"))
    tail = log.orderBy(F.col("end").desc(), F.col("target").desc()).limit(last)
    w = Window.orderBy(F.col("end").desc(), F.col("target").desc())
    outages = total.select("outages").scalar()   # one value: a scalar subquery
    numbered = (tail.withColumn("_r", F.row_number().over(w))
                .withColumn("number", (outages - F.col("_r") + 1).cast("bigint")).drop("_r"))
    return numbered, total


# ---- S04 / S05 server log and audit lines -----------------------------------------------------------

# Fixed value: the server's log_line_prefix, '%m [%p] %q%u@%d app=%a client=%h ', as a pattern.
LOG_LINE = (r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d{3}) (\S+) \[(\d+)\] (?:(\S*)@(\S*) app=(.*?) client=(\S*) )?"
            r"([A-Z]+):  (.*)$")


def _log_parts(col: str) -> Column:
    """The fields of a line from one match of its pattern; one field if it does not match."""
    mark = "\u0001"
    fields = mark.join(f"${i}" for i in (1, 3, 4, 5, 6, 7, 8, 9))
    return F.split(F.regexp_replace(F.col(col), LOG_LINE, fields), mark, 8)


def parse_server_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split each line into time, zone, pid, user, database, application, client, level, message.

    Lines without the prefix (the further lines of a statement of several) are given by
    ``rejected_lines``; the two together are all lines.
    """
    p = [F.get("_p", F.lit(i)) for i in range(8)]
    return lines.select(_log_parts(col).alias("_p")).filter(F.size("_p") == 8).select(
        F.to_timestamp(p[0], "yyyy-MM-dd HH:mm:ss.SSS").cast("timestamp_ntz").alias("ts"),
        p[1].cast("bigint").alias("pid"), F.nullif(p[2], F.lit("")).alias("user"),
        F.nullif(p[3], F.lit("")).alias("db"), F.nullif(p[4], F.lit("")).alias("app"),
        F.nullif(p[5], F.lit("")).alias("client"), p[6].alias("level"), p[7].alias("message"))


def rejected_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """The lines that ``parse_server_log`` leaves out: continuation lines (they begin with a tab) and foreign ones."""
    kind = F.when(F.col(col).startswith("\t"), "continuation").otherwise("foreign")
    return lines.filter(F.size(_log_parts(col)) < 8).select(kind.alias("kind"), F.col(col).alias("line"))


AUDIT = r"AUDIT: SESSION,(\d+),(\d+),([^,]*),([^,]*),([^,]*),([^,]*),(.*),([^,]*)$"


def parse_audit(log: DataFrame) -> DataFrame:
    """pgAudit fields of the ``AUDIT:`` lines: statement ids, class, command, object, statement."""
    m = F.col("message")
    return log.filter(m.startswith("AUDIT: ")).select(
        "ts", "user", "db", F.regexp_extract(m, AUDIT, 1).cast("int").alias("statement_id"),
        F.regexp_extract(m, AUDIT, 3).alias("class"), F.regexp_extract(m, AUDIT, 4).alias("command"),
        F.regexp_extract(m, AUDIT, 5).alias("object_type"), F.regexp_extract(m, AUDIT, 6).alias("object_name"),
        F.regexp_extract(m, AUDIT, 7).alias("statement"))


def statement_report(log: DataFrame) -> DataFrame:
    """Q12: slow statements from the parsed log: per normalised statement (literals replaced),
    count, total and max duration and exact p95 in ms."""
    m = F.col("message")
    dur = F.regexp_extract(m, r"^duration: ([0-9.]+) ms", 1)
    stmt = F.regexp_extract(m, r"statement: (.*)$", 1)
    norm = F.regexp_replace(F.regexp_replace(stmt, r"'[^']*'", "?"), r"\b\d+(\.\d+)?\b", "?")
    s = log.filter(m.startswith("duration: ")).select(norm.alias("statement"), dur.cast("double").alias("ms"))
    totals = s.groupBy("statement").agg(
        F.count(F.lit(1)).alias("calls"), F.round(F.sum("ms"), 3).alias("total_ms"), F.round(F.max("ms"), 3).alias("max_ms"))
    p95 = exact_percentile(s, ["statement"], "ms", 0.95).select("statement", F.round("percentile", 3).alias("p95_ms"))
    return totals.join(p95, "statement")


def error_ranking(log: DataFrame) -> DataFrame:
    """Q12: errors per message."""
    return log.filter(F.col("level") == "ERROR").groupBy("message").agg(F.count(F.lit(1)).alias("errors"))


# ---- S06 / S07 monthly partitions -------------------------------------------------------------------------

def write_monthly(df: DataFrame, path: str, ts: str, rows_per_file: int = 1_000_000) -> None:
    """A log partitioned by month (``month=YYYY-MM``); readers filter on ``month`` and Spark
    prunes folders. Rows are dealt by ranges of (month, time), about ``rows_per_file`` each, so a large
    month is written by as many tasks as it needs, a task writes few files, and no file grows beyond that."""
    tasks = max(1, -(-df.count() // rows_per_file))
    (df.withColumn("month", F.date_format(ts, "yyyy-MM")).repartitionByRange(tasks, "month", ts).sortWithinPartitions("month", ts)
     .write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("month").parquet(path))


def month_filter(start: str, end: str) -> Column:
    """Partition predicate on ``month`` derived from a time range (pruning is not automatic)."""
    return (F.col("month") >= F.lit(start[:7])) & (F.col("month") <= F.lit(end[:7]))


def partition_plan(existing_months: DataFrame, as_of: str, back: int = 12, ahead: int = 3) -> DataFrame:
    """The month calendar (``back`` months before ``as_of`` to ``ahead`` after): months to
    create, to keep, and existing months past retention to drop."""
    first = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), -back)
    last = F.add_months(F.trunc(F.lit(as_of).cast("date"), "month"), ahead)
    spark = existing_months.sparkSession
    cal = spark.range(1).select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("m")) \
        .select(F.date_format("m", "yyyy-MM").alias("month"))
    have = existing_months.select("month").distinct().withColumn("_have", F.lit(True))
    j = cal.withColumn("_in", F.lit(True)).join(have, "month", "full")
    return j.select("month", F.coalesce("_have", F.lit(False)).alias("exists"),
                    F.when(F.col("_in").isNull(), "drop").when(F.col("_have").isNull(), "create")
                    .otherwise("keep").alias("action"))


# ---- S08 chunked export, S09 snapshot, S10 schema evolution --------------------------------------------

def export_chunked(df: DataFrame, path: str, order: Sequence[str], rows: int = 5000) -> None:
    """Ordered export in files of at most ``rows`` records (range-partitioned sort, no
    single-task global sort)."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path))


class Snapshot:
    """Several report steps over one consistent state of their tables.

    The files of every table are fixed at the start (``versions.pinned``), without a copy: each step still
    reads only the columns and row groups it needs. What several steps share beyond that is computed
    once from those tables, as Parquet in the shared folder (``derived``).
    """

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = {name: pinned(df) for name, df in tables.items()}
        self._derived: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def derived(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._derived:
            df = make()
            path = scratch_path(df.sparkSession, f"snapshot/{name}")
            df.write.parquet(path)
            self._derived[name] = df.sparkSession.read.schema(df.schema).parquet(path)
        return self._derived[name]


def evolve(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Add columns with defaults, or fill them where an older file version lacks them."""
    for name, default in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), default) if name in df.columns else default)
    return df
