"""N-gram Jaccard join (2): chosen-path similarity join over word shingles.

Texts become sets of 64-bit shingles of five words. Equal sets collapse into one representative,
so exact copies never meet each other. Then, run by run:

1. Every representative has ``COORDS`` sampled tokens: the smallest token of its set under each of
   ``COORDS`` hash functions. Two sets of Jaccard similarity J share such a token with
   probability J.
2. A node of a run's tree chooses 1/threshold coordinates on average and sends each set to the
   child named by the set's token there. Nodes of up to ``BUCKET`` sets are leaves; larger ones
   are split again, at most ``DEPTH`` times. What is still large then is a leaf as well.
3. Leaves are compared by brute force. A large leaf is cut into blocks of about ``BUCKET`` sets
   and each pair of blocks is a group of its own, so no task holds a whole leaf.
4. A pair at the threshold meets at depth d of one run with probability ``meets(d)``. Runs are
   added until even at the deepest leaf the chance to miss such a pair is below 1 - recall.

A pair that shares several leaves is counted in the smallest one alone, which its two sets' leaf
lists tell; so links are counted without a list of pairs. Sets only travel to leaves where some
partner of a possible size has to be compared with them. They are made anew from the texts of the
documents marked in a bitmap of bounded size, so that the other texts stay where they are.

Result: one row per document with the smallest doc_id of its class (connected component), the
number of links (other distinct shingle sets of similarity >= threshold) and of copies (other
documents with the same shingle set), and whether it is the document that stays of its class.
Shingles are compared by their low 32 bits, sets are identified by 128.

Words are lower-cased runs of letters and digits. A text of one to four words is one shingle. Null
or wordless texts have no shingles, link to nothing and are a class of their own. Null doc_ids
never name a class unless the class holds no other id. Repeated rows count as copies. Further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import (
    components,
    groups,
    keep,
    mix,
    ngrams,
    packed,
    row_spot,
    same,
    sliced,
    spot_test,
    table,
    text_key,
    without,
    word_hashes,
)
from tillbook.session import configure

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
BUCKET = 256
DEPTH = 3
COORDS = 32

_SEEDS = mix(np.arange(1, COORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def meets(depth: int, threshold: float) -> float:
    """The chance that a pair at the threshold shares a leaf of one run at this depth."""
    low, part = divmod(1 / threshold, 1)
    p = 1.0
    for _ in range(depth):
        p = sum(share * (1 - (1 - threshold * p) ** k) for k, share in ((low, 1 - part), (low + 1, part)))
    return p


def runs_for(depth: int, threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold was missed with probability 1 - recall at most."""
    return math.ceil(math.log(1 - recall) / math.log(1 - meets(depth, threshold)))


def _shingles(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    words, offsets = word_hashes(batch.column("text"))
    return [np.unique(ngrams(words[a:b], width)) for a, b in zip(offsets, offsets[1:], strict=False)]


def _set_id(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _fingerprints(width: int):
    def run(batches):
        for batch in sliced(batches, "text"):
            ids, sizes, tokens = [], [], []
            for x in _shingles(batch, width):
                ids.append(_set_id(x))
                sizes.append(len(x))
                if len(x) == 0:
                    tokens.append(None)
                    continue
                low = np.empty(COORDS, np.uint64)
                for k, seed in enumerate(_SEEDS):
                    low[k] = ((x ^ seed) * (seed | np.uint64(1))).min()
                tokens.append(mix(low).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array(ids, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(tokens, pa.list_(pa.int32()))], names=["doc_id", "key", "sid", "n", "tokens"])
    return run


def _sets(width: int, test):
    def run(batches):
        for whole in sliced(batches, "text"):
            batch = whole.filter(pa.array(test(whole.column("spot").to_numpy())))
            if batch.num_rows == 0:
                continue
            found = _shingles(batch, width)
            yield pa.RecordBatch.from_arrays(
                [pa.array([_set_id(x) for x in found], pa.binary()),
                 pa.array([np.unique(x.astype(np.uint32)).tobytes() for x in found], pa.binary())], names=["sid", "shingles"])
    return run


def _leaves(sets: DataFrame, first: int, last: int, threshold: float, bucket: int, depth: int) -> tuple[list[DataFrame], int]:
    """Rows (leaf, sid, n, size) of the runs first..last-1, and the depth of the deepest leaf."""
    low, part = divmod(1 / threshold, 1)
    chosen = [(r, (r * (int(low) + 1) + k) % COORDS) for r in range(first, last)
              for k in range(int(low) + (((r * 0.618034) % 1) < part))]
    child = [F.xxhash64(F.lit(r), F.lit(c), F.element_at("tokens", c + 1)) for r, c in chosen]
    live = sets.select("sid", "n", F.explode(F.array(*child)).alias("leaf"))
    out, level = [], 1
    while True:
        sizes = keep(live.groupBy("leaf").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "join-sizes")
        rows = live.join(sizes, "leaf").select("leaf", "sid", "n", "size")
        big = F.col("size") > bucket
        if level == depth or sizes.where(big).isEmpty():
            return [*out, rows], level
        out.append(rows.where(~big))
        node = F.col("leaf")
        more = F.pmod(F.xxhash64(node, F.lit("more")), F.lit(1 << 20)) < int(part * (1 << 20))
        begin = F.pmod(F.xxhash64(node, F.lit("from")), F.lit(COORDS))
        step = 2 * F.pmod(F.xxhash64(node, F.lit("step")), F.lit(COORDS // 2)) + 1  # odd: the coordinates differ
        coords = F.transform(F.sequence(F.lit(0), F.lit(int(low) - 1) + more.cast("int")),
                             lambda k: F.pmod(begin + k * step, F.lit(COORDS)).cast("int"))
        split = rows.where(big).join(sets.select("sid", "tokens"), "sid").select("sid", "n", "tokens", "leaf", coords.alias("coords"))
        live = keep(split.select("sid", "n", F.explode(F.transform(
            "coords", lambda c: F.xxhash64("leaf", c, F.element_at("tokens", c + 1)))).alias("leaf")), "join-nodes")
        level += 1


def _shared(left: list, right: list) -> np.ndarray:
    """How many members each set of ``left`` shares with each of ``right`` (lists of arrays)."""
    every, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    sizes = [len(x) for x in (*left, *right)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    seen = np.bincount(code, minlength=len(every))
    use = seen[code] > 1
    owner, code = owner[use], (np.cumsum(seen > 1) - 1)[code[use]]
    out = np.zeros((len(left), len(right)), np.float32)
    width = 4096
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for base in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, (base, base + width))
        m = np.zeros((len(sizes), min(width, int(code[-1]) + 1 - base)), np.float32)
        m[owner[a:b], code[a:b] - base] = 1
        out += m[:len(left)] @ m[len(left):].T
    return out


def _pairs(t: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a group's rows: the left rows, the right rows, and which (left, right) pairs are of a
    possible size (a pair within one block once)."""
    side, n = t.column("side").to_numpy(), t.column("n").to_numpy().astype(np.float64)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    within = t.column("low")[0] == t.column("high")[0]
    right = left if within else right
    a, b = n[left][:, None], n[right][None, :]
    fit = np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
    return left, right, np.triu(fit, 1) if within else fit


def _first_met(t: pa.Table, left: np.ndarray, right: np.ndarray, leaf: int) -> np.ndarray:
    """Which pairs share no leaf smaller than this one."""
    lists = [np.array([x for x in v if x < leaf], np.int64) for v in t.column("leaves").to_pylist()]
    return _shared([lists[i] for i in left], [lists[i] for i in right]) == 0


_KEYS = ["leaf", "low", "high"]


def _flag(threshold: float):
    def run(batches):
        yield from packed(flagged(batches))

    def flagged(batches):
        for t in groups(batches, _KEYS):
            left, right, fit = _pairs(t, threshold)
            if not fit.any():
                continue
            fit &= _first_met(t, left, right, t.column("leaf")[0].as_py())
            on = np.zeros(t.num_rows, bool)
            on[left[fit.any(axis=1)]] = True
            on[right[fit.any(axis=0)]] = True
            if on.any():
                yield t.filter(pa.array(on))
    return run


def _verify(threshold: float):
    def run(batches):
        yield from packed(verified(batches))

    def verified(batches):
        for t in groups(batches, _KEYS):
            left, right, fit = _pairs(t, threshold)
            if not fit.any():
                continue
            fit &= _first_met(t, left, right, t.column("leaf")[0].as_py())
            sets = [np.frombuffer(x.as_py(), np.uint32) for x in t.column("shingles")]
            shared = _shared([sets[i] for i in left], [sets[i] for i in right]).astype(np.float64)
            n = t.column("n").to_numpy().astype(np.float64)
            linked = fit & (shared >= threshold * (n[left][:, None] + n[right][None, :] - shared) - 1e-9)
            if not linked.any():
                continue
            links = np.zeros(t.num_rows, np.int64)
            np.add.at(links, left, linked.sum(axis=1))
            np.add.at(links, right, linked.sum(axis=0))
            root = np.arange(t.num_rows)  # of each row's component within the group
            while True:
                before = root.copy()
                for i, j, m in ((left, right, linked), (right, left, linked.T)):
                    low = np.where(m, root[j][None, :], t.num_rows).min(axis=1)
                    root[i] = np.minimum(root[i], low)
                root = root[root]
                if (root == before).all():
                    break
            on = np.flatnonzero(links)
            sid = t.column("sid").combine_chunks()
            yield pa.table({"sid": sid.take(pa.array(on)), "links": links[on], "root": sid.take(pa.array(root[on]))})
    return run


def join(docs: DataFrame, width: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL,
         bucket: int = BUCKET, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id, n_links, n_copies, n_shingles, keeper
    and text_key (which with doc_id tells rows apart)."""
    configure(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key().alias("key"))
    prints = keep(texts.mapInArrow(_fingerprints(width), "doc_id long, key long, sid binary, n int, tokens array<int>"), "join-prints")
    head = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    sets = keep(prints.where("sid is not null").groupBy("sid").agg(
        F.first("n").alias("n"), F.first("tokens").alias("tokens"), F.min(head).alias("head"),
        (F.count(F.lit(1)) - 1).alias("n_copies")), "join-sets")

    found, done, need = [], 0, runs_for(1, threshold, recall)
    while done < need:
        more, deepest = _leaves(sets, done, need, threshold, bucket, depth)
        found += more
        done, need = need, max(need, runs_for(deepest, threshold, recall))
    leaves = found[0]
    for x in found[1:]:
        leaves = leaves.unionByName(x)
    leaves = keep(leaves, "join-leaves")
    lists = keep(leaves.groupBy("sid").agg(F.collect_list("leaf").alias("leaves")), "join-lists")

    blocks = F.ceil(F.col("size") / bucket).cast("int")
    own = F.pmod(F.xxhash64("sid", "leaf"), F.col("blocks")).cast("int")
    rows = (leaves.join(lists, "sid").withColumn("blocks", blocks).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("leaf", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                    (F.col("own") > F.col("other")).cast("int").alias("side"), "sid", "n", "leaves"))
    dealt = rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    flagged = keep(dealt.mapInArrow(_flag(threshold), rows.schema), "join-flagged")

    # one document of each set that has to be compared gives its shingles; what the bitmap lets
    # through by chance ends in the join with the leaves
    carriers = keep(sets.select("sid", row_spot(F.col("head.doc_id"), F.col("head.key")).alias("spot"))
                    .join(flagged.select("sid").distinct(), "sid").select("spot"), "join-carriers")
    wanted = texts.select("text", row_spot(F.col("doc_id"), F.col("key")).alias("spot"))
    wanted = wanted.mapInArrow(_sets(width, spot_test(carriers)), "sid binary, shingles binary").dropDuplicates(["sid"])
    shipped = flagged.join(keep(wanted, "join-shingles"), "sid").repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    linked = keep(shipped.mapInArrow(_verify(threshold), "sid binary, links long, root binary"), "join-links")

    stars = components(linked.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("sid").agg(F.sum("links").alias("n_links"))
    named = (sets.join(stars.withColumnRenamed("node", "sid"), "sid", "left").join(counts, "sid", "left")
             .select("sid", "head", "n_copies", F.coalesce("root", "sid").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    named = keep(named, "join-named")
    heads = keep(named.groupBy("root").agg(F.min("head").alias("first")), "join-heads")
    classes = keep(named.join(heads, "root").select("sid", "first", "n_links", "n_copies"), "join-classes")
    keeper = F.col("first").isNull() | (same(F.col("first.doc_id"), F.col("doc_id")) & (F.col("first.key") == F.col("key")))
    return (prints.select("doc_id", "key", "sid", "n").join(classes, "sid", "left")
            .select("doc_id", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(0)).alias("n_copies"),
                    F.col("n").alias("n_shingles"), keeper.alias("keeper"), F.col("key").alias("text_key")))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of near copies; texts without words all stay."""
    found = keep(join(docs, **options), "join-found").withColumnsRenamed({"doc_id": "its_id", "text_key": "its_key"})
    gone = keep(found.where("not keeper").select("its_id", "its_key").distinct(), "join-gone")
    again = found.where("keeper and n_shingles > 0").groupBy("its_id", "its_key").count().where("count > 1").drop("count")
    again = keep(again, "join-again")
    if again.isEmpty():
        return without(docs, gone)
    mine = [same(docs.doc_id, F.col("its_id")), text_key() == F.col("its_key")]
    once = docs.join(again, mine, "left_semi").withColumn("its_key", text_key()).dropDuplicates(["doc_id", "its_key"]).drop("its_key")
    return without(docs, gone.unionByName(again)).unionByName(once)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the whole documents table."""
    return join(table(spark, sf_dir, "documents", "doc_id", "text")).drop("text_key")
