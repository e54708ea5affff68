"""Versioned Parquet tables (S09, S12): folders that are only added, and a manifest that names the current ones.

A version is a JSON manifest with the folders that make up the table. It is written beside its final name
and renamed, so readers see the old version or the new one, never half of either. Folders of a version
are never written again; those that neither the current nor the previous version names are deleted after a
commit, so a reader that fixed its version keeps its files through one more.

* ``VersionedTable``: replace a whole table, read the current version, or fix it for several reads (S09).
* ``UpsertTable``: one delta folder per micro-batch, compacted into a base of a fixed number of files every
  few batches, the newest row per key on read (S12). What a reader opens does not grow with the batches.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class _Files:
    """The few file-system calls a manifest needs, through Hadoop's FileSystem, so on any store Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, name) if name else self.root)

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def commit(self, name: str, text: str) -> None:
        """Write a file that is there whole or not at all; it must not be there yet."""
        part = self._path(f"_{name.replace('/', '-')}-{uuid.uuid4().hex}")
        out = self.fs.create(part, True)
        out.write(bytearray(text, "utf-8"))
        out.close()
        self.fs.mkdirs(self._path(os.path.dirname(name)))
        if self.fs.exists(self._path(name)) or not self.fs.rename(part, self._path(name)):
            raise RuntimeError(f"another writer has committed {name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class VersionedTable:
    """A table at ``path`` that is replaced as a whole, version by version."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema
        self.files = _Files(spark, path)

    def _versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in self.files.names("manifest") if n.endswith(".json"))

    def manifest(self) -> dict:
        """The current version: its number and folders (none before the first commit)."""
        versions = self._versions()
        if not versions:
            return {"version": 0, "folders": []}
        return json.loads(self.files.read(f"manifest/v{versions[-1]:012d}.json"))

    def _commit(self, content: dict) -> None:
        now = content["version"]
        self.files.commit(f"manifest/v{now:012d}.json", json.dumps(content))
        kept = set(content["folders"])
        for v in self._versions():
            if v < now - 1:
                self.files.delete(f"manifest/v{v:012d}.json")
            elif v < now:
                kept |= set(json.loads(self.files.read(f"manifest/v{v:012d}.json"))["folders"])
        for name in self.files.names("data"):
            if name not in kept:
                self.files.delete(f"data/{name}")

    def _write(self, df: DataFrame, name: str) -> str:
        folder = f"{name}-{uuid.uuid4().hex}"
        df.write.parquet(os.path.join(self.path, "data", folder))
        return folder

    def replace(self, df: DataFrame) -> None:
        """A new version with the rows of ``df``."""
        last = self.manifest()["version"]
        self._commit({"version": last + 1, "folders": [self._write(df.select(*self.schema.names), "table")]})

    def _read(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[os.path.join(self.path, "data", f) for f in folders])

    def read(self) -> DataFrame:
        """The current version; a frame, once made, keeps to it."""
        return self._read(self.manifest()["folders"], self.schema)


class UpsertTable(VersionedTable):
    """A keyed table fed by micro-batches: the row of the newest batch per key.

    A replayed batch replaces its delta, or does nothing once it is in the base. A base has ``buckets`` files,
    dealt by the key and sorted by it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 8, compact_every: int = 10):
        super().__init__(spark, path, schema)
        self.keys, self.buckets, self.compact_every = list(keys), buckets, compact_every
        self.stored = T.StructType([*schema.fields, T.StructField("_batch", T.LongType())])

    def manifest(self) -> dict:
        return {"base": [], "through": -1, "deltas": {}} | super().manifest()

    def _newest(self, folders: Sequence[str]) -> DataFrame:
        rows = self._read(folders, self.stored)
        values = [c for c in self.stored.names if c not in self.keys]
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_batch").alias("_r")).select(*self.keys, "_r.*")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` sink."""
        m = self.manifest()
        if batch_id <= m["through"]:
            return
        delta = self._write(batch.select(*self.schema.names, F.lit(batch_id).cast("long").alias("_batch")), f"delta-{batch_id}")
        base, through, deltas = m["base"], m["through"], m["deltas"] | {str(batch_id): delta}
        if len(deltas) >= self.compact_every:
            merged = self._newest([*base, *deltas.values()]).select(*self.stored.names)
            base = [self._write(merged.repartition(self.buckets, *self.keys).sortWithinPartitions(*self.keys), f"base-{batch_id}")]
            through, deltas = batch_id, {}
        self._commit({"version": m["version"] + 1, "folders": [*base, *deltas.values()], "base": base, "through": through, "deltas": deltas})

    def read(self) -> DataFrame:
        return self._newest(self.manifest()["folders"]).select(*self.schema.names)


def pinned(df: DataFrame) -> DataFrame:
    """A file table as it is now: the same files, whatever is added to its folder later.

    Nothing is copied, and filters and columns are still pushed down. Files that a plain table deletes
    cannot be kept this way, and reading them fails instead of changing the result; a ``VersionedTable`` keeps them.
    """
    files = df.inputFiles()
    return df.sparkSession.read.schema(df.schema).parquet(*files) if files else df.limit(0)
