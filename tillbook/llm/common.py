"""Helpers the operators share: tables, intermediate tables, Arrow slices and word hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.session import configure, scratch_path

SLICE_BYTES = 2 << 20
BITMAP_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The given columns of one table."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: lineage ends here, so a
    lost executor costs at most the tasks of the running job."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """Give freed memory back at the end of a task: Python workers are reused by later stages, whose
    memory would otherwise come on top of what Arrow and malloc still hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def sliced(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of a slice stay near ``limit`` bytes (one row at least)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
    release()


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, offsets by text): lower-cased runs of letters and digits.

    A null text has no words.
    """
    low = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    spaced = pc.utf8_trim(pc.replace_substring_regex(low, r"[^\p{L}\p{N}]+", " "), " ")
    lists = pc.split_pattern(spaced, " ")
    words = lists.flatten().dictionary_encode()
    lut = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    hashes = lut[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.empty(0, np.uint64)
    offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))
    empty = pc.equal(pc.binary_length(spaced), 0).to_numpy(zero_copy_only=False)
    if empty.any():  # splitting "" gives one empty word
        real = np.ones(len(hashes), bool)
        real[offsets[:-1][empty]] = False
        hashes = hashes[real]
        offsets = np.concatenate(([0], np.cumsum(np.diff(offsets) - empty)))
    return hashes, offsets.astype(np.int64)


_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n-word windows of one text; a shorter text is one window of all its words."""
    n = min(n, len(words))
    if n == 0:
        return np.empty(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total = total * np.uint64(_MIX[0]) + words[k:len(words) - n + 1 + k]
    return mix(total)


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, in a partition that is sorted by the keys; only one group and one
    batch are held at a time."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.table({n: batch.column(n) for n in batch.schema.names})
        change = np.zeros(t.num_rows, bool)
        for k in keys:
            v = t.column(k).combine_chunks().to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), t.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(t.column(k)[a].as_py() for k in keys)
            if key != last and held:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(a, b - a))
            last = key
    if held:
        yield pa.concat_tables(held)
    held = []
    release()


def packed(tables: Iterable[pa.Table], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Many small tables as few Arrow batches."""
    held: list[pa.Table] = []
    count = 0
    for t in tables:
        held.append(t)
        count += t.num_rows
        if count >= rows:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
            held, count = [], 0
    if held:
        yield from pa.concat_tables(held).combine_chunks().to_batches()


def same(a, b):
    """Null-safe equality of two columns."""
    return a.eqNullSafe(b)


def text_key(column: str = "text"):
    """A 64-bit key of a text, computed natively (null counts as empty)."""
    return F.xxhash64(F.coalesce(F.col(column), F.lit("")))


def row_spot(doc_id, key):
    """A row's place in bitmaps, from its doc_id and the key of its text."""
    return F.xxhash64(doc_id, key).bitwiseAND(F.lit((1 << 62) - 1))


def spot_test(rows: DataFrame):
    """A test, for tasks, which of an array of row spots can be among those of ``rows`` (column spot).

    The spots become a bitmap of 16 bits a row, at most ``BITMAP_BYTES`` in all, which is broadcast. What
    it marks by chance (more, if it is full) has to be told apart by an exact join afterwards; what it
    does not mark needs no join, so its texts are not shuffled.
    """
    words = 1 << max(4, min((BITMAP_BYTES // 8).bit_length() - 1, (max(1, rows.count()) * 16 // 64).bit_length()))
    spot = F.col("spot") % (64 * words)
    found = rows.groupBy(F.floor(spot / 64).cast("long").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))).alias("bits")).toArrow()
    bits = np.zeros(words, np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    sent = rows.sparkSession.sparkContext.broadcast(bits)

    def test(spots: np.ndarray) -> np.ndarray:
        own, at = sent.value, spots % (64 * len(sent.value))
        return (own[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1

    return test


def without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) less the rows whose id and text key are in ``rows`` (its_id, its_key)."""
    test = spot_test(rows.select(row_spot(F.col("its_id"), F.col("its_key")).alias("spot")))

    @F.pandas_udf("boolean")
    def marked(spots: pd.Series) -> pd.Series:
        return pd.Series(test(spots.to_numpy()))

    spot = row_spot(docs.doc_id, text_key())
    rest = docs.where(marked(spot)).join(rows, [same(docs.doc_id, F.col("its_id")), text_key() == F.col("its_key")], "left_anti")
    return docs.where(~marked(spot)).unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): one row (node, root), root the smallest node.

    Alternating large-star and small-star rounds until the edges stop changing; they then are
    stars around the smallest node of each component. Each round is written to the shared folder.
    Joins on a hub read two plain exchanges, so the adaptive planner can split them.
    """
    def stars(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = both.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not large:
            both = both.where("v < u")
        low = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        out = both.join(low, "u")
        if large:
            return out.where("v > u").select(F.col("v").alias("b"), F.col("m").alias("a")).where("a <> b").distinct()
        moved = out.where("v <> m").select(F.col("v").alias("b"), F.col("m").alias("a"))
        return moved.unionByName(low.select(F.col("u").alias("b"), F.col("m").alias("a"))).distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = keep(edges.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a")).where("a <> b").distinct(), "cc")
    before = mark(now)
    while before[0]:
        now = keep(stars(keep(stars(now, True), "cc"), False), "cc")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
