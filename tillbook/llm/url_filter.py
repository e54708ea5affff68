"""URL filters (7): allow and block rules in a sorted digest array.

A rule is a host, the beginning of a path and a verdict. It fits its host and all subdomains if the
url's path begins with the rule's; the longest rule text (host and path) wins, then the longer host.

The rules become one file: the sorted 64-bit xxhash keys of the rule texts, and beside them the full
texts, the verdicts and the lengths of host. Spark ships the file to every executor, whose tasks
map it into memory. A url gives one key for each suffix of its host at a dot and each length of
rule path; all keys of a batch are found by one vectorised binary search, and every hit is
confirmed against the stored text, so equal digests of different texts do no harm.

The file is made only while the rules hold at most ``MAX_RULE_BYTES``; a larger list is joined
with the keys by Spark instead (``judge_joined``), with the same result.

The host lies after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the path
from there up to ``?``, ``#`` or the end. Both are empty if the url is null or has no ``://``. A url that no
rule fits gets the default verdict (allow: the list names what to block) and a null rule. Rules with
a null host or path are ignored; of rules of equal text, block wins. Repeated pages give repeated
rows; an empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

import functools
import mmap
import os
import struct
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import keep, table
from tillbook.session import configure

# The rules of the registered query: fixed values.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
DEFAULT = "allow"
MAX_RULE_BYTES = 256 << 20
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def parts(url):
    """(host, path) of a url column."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    after = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(after, F.length(host) + 1), r"^[^?#]*", 0)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(has, low).otherwise(""), F.when(has, path).otherwise("")


def build(rules: list[tuple[str, str, str]], path: str) -> None:
    """Write the digest array: numbers of rules and text bytes, sorted keys, text offsets, host sizes, verdicts, texts."""
    rows = sorted((xxhash.xxh64_intdigest(f"{h}\0{p}"), f"{h}{p}".encode(), len(h.encode()), v != "block") for h, p, v in set(rules))
    unique = [r for k, r in enumerate(rows) if k == 0 or r[:3] != rows[k - 1][:3]]  # block sorts first
    texts = b"".join(r[1] for r in unique)
    with open(path, "wb") as f:
        f.write(struct.pack("<QQ", len(unique), len(texts)))
        f.write(np.array([r[0] for r in unique], "<u8").tobytes())
        f.write(np.cumsum([0, *(len(r[1]) for r in unique)]).astype("<u8").tobytes())
        f.write(np.array([r[2] for r in unique], "<u4").tobytes())
        f.write(np.array([r[3] for r in unique], "u1").tobytes())
        f.write(texts)


class Digests:
    """A digest array mapped into memory."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        n, size = struct.unpack_from("<QQ", data)
        at = 16
        self.keys = np.frombuffer(data, "<u8", n, at)
        self.offsets = np.frombuffer(data, "<u8", n + 1, at := at + 8 * n)
        self.hosts = np.frombuffer(data, "<u4", n, at := at + 8 * (n + 1))
        self.allow = np.frombuffer(data, "u1", n, at := at + 4 * n)
        self.texts = memoryview(data)[at + n:at + n + size]

    def path_sizes(self) -> list[int]:
        """The lengths, in characters, of the rules' paths."""
        return sorted({len(bytes(self.texts[a + h:b]).decode()) for a, b, h in
                       zip(self.offsets.tolist(), self.offsets[1:].tolist(), self.hosts.tolist(), strict=False)})

    def find(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """The rule number of each (host, path) text, or -1."""
        probe = np.fromiter((xxhash.xxh64_intdigest(f"{h}\0{p}") for h, p in zip(hosts, paths, strict=True)), np.uint64, len(hosts))
        out = np.full(len(probe), -1, np.int64)
        at = np.searchsorted(self.keys, probe)
        todo = np.flatnonzero(at < len(self.keys))
        while len(todo):  # more than once only where rules share a digest
            todo = todo[self.keys[at[todo]] == probe[todo]]
            for k in todo.tolist():
                a, b = int(self.offsets[at[k]]), int(self.offsets[at[k] + 1])
                text = hosts[k].encode()
                if self.hosts[at[k]] == len(text) and self.texts[a:b] == text + paths[k].encode():
                    out[k] = at[k]
            todo = todo[out[todo] < 0]
            at[todo] += 1
            todo = todo[at[todo] < len(self.keys)]
        return out


@functools.lru_cache(maxsize=4)
def _mapped(name: str) -> Digests:
    return Digests(SparkFiles.get(name))


def candidates(host: str, path: str, sizes: list[int]) -> list[tuple[str, str]]:
    """Every (host suffix, path beginning) that a rule could have, longest text first, then longest host."""
    dots = [0, *(k + 1 for k, c in enumerate(host) if c == ".")]
    both = [(host[d:], path[:s]) for d in dots for s in sizes if s <= len(path)]
    return sorted(both, key=lambda x: (-len(x[0]) - len(x[1]), -len(x[0])))


def _judge(name: str, default: str):
    def run(batches):
        rules = _mapped(name)
        sizes = rules.path_sizes()
        for batch in batches:
            pairs = pa.table({"h": batch.column("host"), "p": batch.column("path")}).to_pylist()
            lists = [candidates(x["h"], x["p"], sizes) for x in pairs]
            owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            flat = [x for own in lists for x in own]
            found = rules.find([x[0] for x in flat], [x[1] for x in flat])
            hit = np.flatnonzero(found >= 0)
            first = hit[np.unique(owner[hit], return_index=True)[1]]
            rule, verdict = [None] * len(lists), [default] * len(lists)
            for k in first.tolist():
                rule[owner[k]] = "".join(flat[k])
                verdict[owner[k]] = "allow" if rules.allow[found[k]] else "block"
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in batch.schema.names), pa.array(rule, pa.string()),
                                              pa.array(verdict, pa.string())], names=[*batch.schema.names, "rule", "verdict"])
    return run


def judge_mapped(pages: DataFrame, rules: list[tuple[str, str, str]], default: str = DEFAULT) -> DataFrame:
    """``pages`` (page_id, host, path) with rule and verdict, by the shipped digest array."""
    name = f"rules-{uuid.uuid4().hex}.digests"
    folder = tempfile.mkdtemp(prefix="tillbook-rules-")  # read by the driver alone, which ships the file
    build(rules, os.path.join(folder, name))
    pages.sparkSession.sparkContext.addFile(os.path.join(folder, name))
    return pages.mapInArrow(_judge(name, default), "page_id long, host string, path string, rule string, verdict string")


def judge_joined(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """The same by a join on the rule texts, for lists too large to ship."""
    sizes = [r[0] for r in rules.select(F.length("path")).distinct().collect()]  # a few lengths
    pages = keep(pages.withColumn("row", F.monotonically_increasing_id()), "urls")
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat_ws(".", F.slice(labels, k, F.size(labels))))
    probe = (pages.select("row", "path", F.explode(suffix).alias("host"))
             .select("row", "host", F.explode(F.array(*[F.when(F.length("path") >= s, F.substring("path", 1, s)) for s in sizes])).alias("path"))
             .where("path is not null"))
    one = rules.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block"))
    rank = F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("of_host"),
                    F.concat("host", "path").alias("rule"), "block")
    best = probe.join(one, ["host", "path"]).groupBy("row").agg(F.max(rank).alias("best"))
    return pages.join(best, "row", "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.when(
        F.col("best").isNull(), default).otherwise(F.when(F.col("best.block"), "block").otherwise("allow")).alias("verdict"))


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, max_rule_bytes: int = MAX_RULE_BYTES) -> DataFrame:
    """page_id, host, path, rule and verdict of ``pages`` (page_id, url) under ``rules`` (host, path, verdict)."""
    configure(pages.sparkSession)
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = rules.select("host", "path", "verdict").where("host is not null and path is not null")
    size = rules.agg(F.sum(F.octet_length("host") + F.octet_length("path") + 24)).first()[0] or 0
    if size > max_rule_bytes:
        return judge_joined(split, rules, default)
    return judge_mapped(split, [tuple(r) for r in rules.collect()], default)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every url of the pages table under RULES."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return judge(pages, spark.createDataFrame(list(RULES), "host string, path string, verdict string"))


def oracle() -> str:
    """The same in DuckDB."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
WITH rules(rh, rp, v) AS (VALUES {rules}),
a AS (SELECT page_id, row_number() OVER () AS line, url, coalesce(strpos(url, '://'), 0) AS k FROM pages),
b AS (SELECT page_id, line, CASE WHEN k > 0 THEN substr(url, k + 3) ELSE '' END AS rest FROM a),
c AS (SELECT page_id, line, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM b),
d AS (SELECT page_id, line, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM c),
e AS (SELECT line, max_by(rh || rp, (length(rh) + length(rp)) * 100000 + length(rh)) AS rule,
             max_by(v, (length(rh) + length(rp)) * 100000 + length(rh)) AS v
      FROM d JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY line)
SELECT page_id, host, path, rule, coalesce(v, '{DEFAULT}') AS verdict FROM d LEFT JOIN e USING (line)
"""
