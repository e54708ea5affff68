"""Token-ID output (1): bit-plane shuffled shards with a chunk index.

Documents are encoded, put in ascending doc_id order and written as a store of three Parquet
datasets, so that Spark's commit protocol covers lost tasks and any file system Spark reaches:

* ``planes/``  one row per chunk: the ids of a run of whole documents, cut into blocks of
  ``block`` ids. A block is a matrix of little-endian unsigned 32-bit ids; it is transposed into
  its 4 byte planes (or 32 bit planes) and each plane is compressed with zstandard. ``payload``
  is the concatenation of the planes.
* ``index/``   one row per chunk without the payload: documents, first position in the shard and
  the size of each compressed plane, which gives the offset of any block.
* ``shards/``  one row per shard: its number of ids and the position of its first id.

A shard is one range of doc_id. A chunk ends with the first document that takes it to
``chunk`` ids, so a document never straddles chunks and readers need no shuffle.

Null texts are empty; a null doc_id sorts first; rows that repeat a doc_id are ordered by a 64-bit hash of
the text, then the text, and stay separate documents; an empty table gives an empty store. The literal of the tokenizer's special
token in a text gives that token's id, as the library does by default. Further columns are ignored.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.llm.common import release, sliced, table, text_key
from tillbook.session import configure, scratch_path

TOKENIZER = "byte_bpe_50k.json"
END = 2
BLOCK = 1 << 14
CHUNK = 1 << 18
CACHE_BYTES = 24 << 20  # of words and their ids, of each kind
RUN = 256  # words encoded as one text
SPACE = "\u0120"  # how byte-level vocabularies write a space
SLICE_BYTES = 4 << 20  # fewer repeats of common words than the default

_CHUNKS = ("shard int, chunk int, start_in_shard long, n_ids long, doc_ids array<long>, doc_sizes array<long>, "
           "plane_sizes array<int>, payload binary")
_DOCS = "shard int, start_in_shard long, doc_id long, n_tokens long, ids binary"
# A space between two other-than-space characters starts a new piece of the tokenizer's own split,
# so a text may be cut there. Texts with other spacing are encoded whole.
_UNSAFE = r"(?s)[\s\x0b\x1c-\x1f\x{85}\p{Z}] | [\s\x0b\x1c-\x1f\x{85}\p{Z}]|^ | $"


def vocabulary(name: str = TOKENIZER) -> str:
    """Where a public tokenizer file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches [start, start + size) of ``flat``, one after the other."""
    ends = np.cumsum(size)
    return flat[np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


class Words:
    """The ids of distinct words that follow ``lead``: the words as one Arrow array, their ids as one flat array.

    ``opens`` tells the ids whose piece begins with a space. Space-led words are encoded ``RUN`` at a time as one text,
    which costs less than a call each: a word's ids begin where a piece begins with a space, as the word has none.
    """

    def __init__(self, tok, lead: str, opens: np.ndarray | None = None):
        self.tok, self.lead, self.opens = tok, lead, opens
        self.clear()

    def _encode(self, words: list[str], run: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and the number of each."""
        texts = [self.lead + self.lead.join(words[a:a + run]) for a in range(0, len(words), run)]
        parts = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(parts)
        if run == 1:
            return flat, np.fromiter(map(len, parts), np.int64, len(parts))
        starts = np.flatnonzero(self.opens[flat])
        if len(starts) != len(words) or starts[0] != 0:  # a vocabulary that writes spaces otherwise
            return self._encode(words, 1)
        return flat, np.diff(np.append(starts, len(flat)))

    def clear(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.flat, self.start, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def nbytes(self) -> int:
        return self.words.nbytes + self.flat.nbytes + self.start.nbytes + self.size.nbytes

    def entries(self, words: pa.Array) -> np.ndarray:
        """The places of ``words`` (distinct), which are encoded if they are new."""
        at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            unknown = pc.is_null(at)
            new = words.filter(unknown)
            flat, size = self._encode(new.to_pylist(), 1 if self.opens is None else RUN)
            places = np.arange(len(self.size), len(self.size) + len(size))
            self.words = pa.concat_arrays([self.words, new])
            self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(size) - size))
            self.size = np.concatenate((self.size, size))
            self.flat = np.concatenate((self.flat, flat))
            at = pc.replace_with_mask(at, unknown, pa.array(places, pa.int32()))
        return at.to_numpy(zero_copy_only=False).astype(np.int64)


class Encoder:
    """Ids of many texts at once: each distinct space-led word of the texts is encoded once."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        opens = np.zeros(self.tok.get_vocab_size(), bool)
        opens[[i for piece, i in self.tok.get_vocab().items() if piece.startswith(SPACE)]] = True
        self.first, self.led = Words(self.tok, ""), Words(self.tok, " ", opens)  # words that begin a text, and others

    def clear(self) -> None:
        self.first.clear()
        self.led.clear()

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by the end id, and the number of ids of each text with it."""
        for words in (self.first, self.led):
            if words.nbytes() > CACHE_BYTES:
                words.clear()
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        whole = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        n_words = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        firsts = np.cumsum(n_words) - n_words
        led = np.ones(int(n_words.sum()), bool)
        led[firsts] = False
        parts = lists.flatten()
        start, size = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        flat, shift = [], 0
        for words, mine in ((self.first, ~led), (self.led, led)):
            if mine.any():
                own = parts.filter(pa.array(mine)).dictionary_encode()
                at = words.entries(own.dictionary)[own.indices.to_numpy(zero_copy_only=False)]
                start[mine], size[mine] = words.start[at] + shift, words.size[at]
                flat.append(words.flat)
                shift += len(words.flat)
        # the texts that may not be cut are encoded whole, and stand in for their one empty word
        for k in np.flatnonzero(whole):
            ids = np.array(self.tok.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, np.uint32)
            start[firsts[k]], size[firsts[k]] = shift, len(ids)
            flat.append(ids)
            shift += len(ids)
        # and the end id stands behind the last word of every text
        lasts = np.cumsum(n_words)
        start, size = np.insert(start, lasts, shift), np.insert(size, lasts, 1)
        flat.append(np.array([end], np.uint32))
        upto = np.concatenate(([0], np.cumsum(size)))
        bounds = np.concatenate(([0], lasts + np.arange(1, len(lasts) + 1)))
        return gather(np.concatenate(flat), start, size), np.diff(upto[bounds])


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def to_planes(ids: np.ndarray, bits: bool, level: int = 3) -> list[bytes]:
    """The compressed planes of one block: 4 byte planes, or 32 bit planes from the highest bit down."""
    cells = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if bits:
        wide = np.unpackbits(np.ascontiguousarray(cells)[::-1], axis=1).reshape(4, -1, 8)
        cells = np.packbits(wide.transpose(0, 2, 1).reshape(32, -1), axis=1)
    zip_ = zstandard.ZstdCompressor(level=level)
    return [zip_.compress(np.ascontiguousarray(p).tobytes()) for p in cells]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The inverse of to_planes, for a block of n ids."""
    unzip = zstandard.ZstdDecompressor()
    if len(planes) == 4:
        cells = np.stack([np.frombuffer(unzip.decompress(p, max_output_size=n), np.uint8) for p in planes])
    else:
        width = (n + 7) // 8
        rows = np.stack([np.frombuffer(unzip.decompress(p, max_output_size=width), np.uint8) for p in planes])
        wide = np.unpackbits(rows, axis=1, count=n).reshape(4, 8, n).transpose(0, 2, 1).reshape(4, -1)
        cells = np.packbits(wide, axis=1)[::-1]
    return np.ascontiguousarray(cells.T).view("<u4").ravel()


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _writer(path: str, end: int, block: int, chunk: int, bits: bool):
    def run(batches):
        from pyspark import TaskContext

        shard, number, start = TaskContext.get().partitionId(), 0, 0
        encoder = _encoder(path)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # doc_ids, sizes and ids of the open chunk
        count = 0

        def flush():
            docs, sizes, flat = (np.concatenate(x) for x in zip(*held, strict=True))
            planes = [p for a in range(0, len(flat), block) for p in to_planes(flat[a:a + block], bits)]
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()), pa.array([len(flat)], pa.int64()),
                _one_list(pa.array(docs, pa.int64(), from_pandas=True)), _one_list(pa.array(sizes, pa.int64())),
                _one_list(pa.array([len(p) for p in planes], pa.int32())), pa.array([b"".join(planes)], pa.binary())], schema=_CHUNK_ARROW)

        for batch in sliced(batches, "text", SLICE_BYTES):
            # doc_ids with null as a masked object, as numpy has no null long
            doc_ids = batch.column("doc_id").to_numpy(zero_copy_only=False) if not batch.column("doc_id").null_count else np.array(
                batch.column("doc_id").to_pylist(), object)
            flat, sizes = encoder.encode(batch.column("text"), end)
            ends = np.cumsum(sizes)
            a = 0
            while a < len(sizes):
                # the first document that takes the chunk to its size ends it
                done = ends[a - 1] if a else 0
                b = min(int(np.searchsorted(ends, done + chunk - count)) + 1, len(sizes))
                held.append((doc_ids[a:b], sizes[a:b], flat[done:ends[b - 1]]))
                count += int(ends[b - 1] - done)
                if count >= chunk:
                    yield flush()
                    number, start = number + 1, start + count
                    held, count = [], 0
                a = b
        if held:
            yield flush()
        held = []
        encoder.clear()
        release()
    return run


_CHUNK_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("start_in_shard", pa.int64()),
                          ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
                          ("plane_sizes", pa.list_(pa.int32())), ("payload", pa.binary())])


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, block: int = BLOCK,
                chunk: int = CHUNK, bits: bool = False) -> None:
    """Encode ``docs`` (doc_id, text) and write the store to ``path``."""
    spark = configure(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    ranged = (docs.select("doc_id", text.alias("text"))
              .repartitionByRange(F.col("doc_id").asc_nulls_first(), text_key())
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), text_key(), "text"))
    ranged.mapInArrow(_writer(tokenizer or vocabulary(), end, block, chunk, bits), _CHUNKS).write.option(
        "compression", "uncompressed").parquet(f"{path}/planes")
    spark.read.parquet(f"{path}/planes").drop("payload").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"), F.sum(F.size("doc_ids")).alias("n_docs"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long"))).coalesce(1).write.parquet(
        f"{path}/shards")


def _reader(block: int):
    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(n)[row].as_py() for n in ("shard", "start_in_shard", "n_ids", "doc_ids", "doc_sizes")}
                sizes = batch.column("plane_sizes")[row].as_py()
                payload = batch.column("payload")[row].as_buffer()
                view, blocks = memoryview(payload), -(-r["n_ids"] // block)
                per, at, out = len(sizes) // max(blocks, 1), 0, []
                for k in range(blocks):
                    planes = []
                    for size in sizes[k * per:(k + 1) * per]:
                        planes.append(view[at:at + size])
                        at += size
                    out.append(from_planes(planes, min(block, r["n_ids"] - k * block)))
                flat = np.concatenate(out)
                ends = np.cumsum(np.array(r["doc_sizes"], np.int64))
                starts = ends - r["doc_sizes"]
                n = len(ends)
                ids = pa.Array.from_buffers(pa.large_binary(), n, [
                    None, pa.py_buffer(np.append(starts, ends[-1:]) * 4), pa.py_buffer(flat.astype("<u4"))])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, r["shard"], np.int32)), pa.array(r["start_in_shard"] + starts),
                    pa.array(r["doc_ids"], pa.int64()), pa.array(r["doc_sizes"], pa.int64()), ids.cast(pa.binary())],
                    names=["shard", "start_in_shard", "doc_id", "n_tokens", "ids"])
    return run


def read_store(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """One row per document of a store: doc_id, start, n_tokens and ids (little-endian unsigned 32-bit)."""
    docs = spark.read.parquet(f"{path}/planes").mapInArrow(_reader(block), _DOCS)
    shards = spark.read.parquet(f"{path}/shards").select("shard", "start")
    return docs.join(shards, "shard").select("doc_id", (F.col("start") + F.col("start_in_shard")).alias("start"),
                                             "n_tokens", "ids")


def digests(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a new store, read it back and describe each document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-store")
    write_store(docs, path)
    return read_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: the whole documents table through the store."""
    return digests(table(spark, sf_dir, "documents", "doc_id", "text"))
