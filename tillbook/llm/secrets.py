"""Secret scans (8): an incremental ledger of content-addressed blobs.

Every version of a path is a row (path, content). Its blob id is the SHA-256 of the content. The
ledger is a folder of Parquet batches with one row per scanned blob and rule version, findings or
not. A scan

1. takes the blobs that the ledger lacks under the rule version in force,
2. scans one carrier of each, however many paths and versions hold it,
3. appends the findings as one batch (Spark's commit protocol: a lost task is repeated, a failed
   scan leaves no batch), and
4. joins the ledger's findings back to all paths.

The rule version is a digest of the patterns, so changed rules rescan everything and unchanged ones
nothing. A blob that two scans at once have put in twice is read once.

Kinds, in order: ``assign`` (a password, token or key given a value of 6 or more characters),
``access`` (AKIA and capitals or digits, 20 or more characters), ``hex`` (24 or more lower-case
hexadecimal digits). Matches are leftmost and do not overlap within a kind; those that are too
short are dropped. Offsets are code points, ends exclusive.

Null content is empty. A null path is a path like any other; repeated rows give repeated rows. An
empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import keep, same, sliced, table
from tillbook.session import configure, scratch_path

KINDS = ("assign", "access", "hex")
# The patterns, and which group must have how many characters.
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
_WORDS = ("passw", "secret", "token", "api")
_FINDINGS = "blob string, rule_version string, n_assign long, n_access long, n_hex long, spans string"


def rule_version() -> str:
    """The digest of the patterns in force."""
    return hashlib.sha256(repr([(k, PATTERNS[k]) for k in KINDS]).encode()).hexdigest()[:16]


_ASSIGN = re.compile(PATTERNS["assign"][0], re.ASCII)
_ACCESS = re.compile(PATTERNS["access"][0])
# a maximal run of at least 24 digits is what the shorter pattern finds, less the runs to drop
_HEX = re.compile(r"[0-9a-f]{24,}")


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all findings, by start and then by the order of KINDS."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= PATTERNS["assign"][2]]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= PATTERNS["access"][2]]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _scanner(version: str):
    def run(batches):
        for batch in sliced(batches, "content"):
            rows = [spans(t or "") for t in batch.column("content").to_pylist()]
            counts = [pa.array([sum(s[2] == k for s in r) for r in rows], pa.int64()) for k in KINDS]
            told = pa.array([",".join(f"{k}:{a}:{b}" for a, b, k in r) for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array([version] * len(rows), pa.string()), *counts, told],
                                             names=["blob", "rule_version", "n_assign", "n_access", "n_hex", "spans"])
    return run


def _ledger(spark: SparkSession, path: str, version: str) -> DataFrame:
    """The ledger's rows of one rule version."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], _FINDINGS)
    batches = spark.read.schema(_FINDINGS).option("recursiveFileLookup", "true").parquet(path)
    return batches.where(F.col("rule_version") == version)


def scan(versions: DataFrame, ledger: str, version: str | None = None) -> DataFrame:
    """Findings of all rows of ``versions`` (path, content): path, blob, n_assign, n_access, n_hex, spans.

    ``ledger`` is a folder; it is made if it is missing and grows by a batch if there are unseen blobs.
    """
    spark = configure(versions.sparkSession)
    version = version or rule_version()
    content = F.coalesce("content", F.lit(""))
    blobs = versions.select("path", content.alias("content"), F.sha2(content, 256).alias("blob"))
    paths = keep(blobs.select("path", "blob"), "blob-paths")
    known = _ledger(spark, ledger, version).select("blob").distinct()
    carriers = paths.groupBy("blob").agg(F.min("path").alias("carrier")).join(known, "blob", "left_anti")
    carriers = keep(carriers.withColumnRenamed("blob", "unseen"), "blob-carriers")
    held = blobs.join(carriers, (blobs.blob == carriers.unseen) & same(blobs.path, carriers.carrier), "left_semi")
    held.select("blob", "content").mapInArrow(_scanner(version), _FINDINGS).dropDuplicates(["blob"]).write.parquet(
        scratch_path_in(ledger, version))
    found = _ledger(spark, ledger, version).drop("rule_version").dropDuplicates(["blob"])
    return paths.join(keep(found, "blob-findings"), "blob")


def scratch_path_in(ledger: str, version: str) -> str:
    """The folder of a new batch of a ledger."""
    import uuid

    return f"{ledger}/rules={version}/batch-{uuid.uuid4().hex}"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document, with a ledger that starts empty."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan(docs.select(F.col("doc_id").alias("path"), F.col("text").alias("content")), scratch_path(spark, "ledger"))
    return found.select(F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex",
                        F.sha2("spans", 256).alias("base_sha256"), "spans")
