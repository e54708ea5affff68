"""Document fingerprints (12, native): consistent weighted sampling of weighted terms.

A text's terms are its words (lower-cased runs of letters and digits), weighted by their counts. For
each of ``SAMPLES`` samples k and term x of weight w, a hash of (x, k) gives two Gamma(2, 1) draws r and
c and a uniform draw b, the same in every text. The draws come from tables of quantiles (12 bits; 24 for
the small values of c, which decide), since a logarithm a draw would be most of the work. With
t = floor(ln w / r + b) the term's value is ln c - r (t - b + 1), and the sample is the pair (x, t) of the smallest value (Ioffe's scheme). Two texts
have the same sample with probability sum of min weights / sum of max weights, their generalised Jaccard
similarity. The share of equal samples estimates it, with a standard error of 0.0625 at most.

A sample is kept in 16 bits, so two different ones look equal with chance 2^-16. A signature is 16 longs
of four samples each; the fingerprint is their hexadecimal form. It depends on the words alone, so equal
texts have equal fingerprints. A text without words (also a null one) has the empty fingerprint, with a
likeness of 1 to another empty one and 0 to any other.

All of it is DataFrame code: words are counted and sampled by two aggregations that stay in the partition
to which a document's text was dealt, so only texts and signatures are shuffled.

``edited_pairs`` needs the next document in descending doc_id. Ids are put in order in ranges, one task
each, and each range's last row takes the first row of the next range. Documents of the same doc_id are
in the order of 64-bit hashes of their texts; null doc_ids come last; after the last comes the first.
Rows that repeat doc_id and text are one document in that order, and each of them is returned. A single
document is its own next. Empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.llm.common import keep, table
from tillbook.session import configure

SAMPLES = 64
LANES = 4  # samples in a long
NO_LETTER = r"[^\p{L}\p{N}]+"
CELLS = 1 << 12  # of the tables of draws
COPIES = 10_000  # repeated rows are given back in blocks of so many
_OFFSET, _SCALE = 128.0, float(1 << 23)  # values lie between -75 and 4


def terms(text: Column) -> Column:
    """The words of a text, an array."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NO_LETTER, -1), "")


def term_weights(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, term (a 64-bit hash; null if there is none) and weight of ``docs`` (keys, text).

    There is no shuffle if ``docs`` is partitioned by some of the keys.
    """
    words = docs.select(*keys, F.explode_outer(terms(F.col("text"))).alias("word"))
    words = words.select(*keys, F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"))
    return words.groupBy(*keys, "term").agg(F.count("term").alias("weight"))


def gamma_quantiles(at: list[float]) -> list[float]:
    """Quantiles of the Gamma(2, 1) distribution, whose distribution function is 1 - (1 + x) exp(-x)."""
    out = []
    for u in at:
        x = math.sqrt(2 * u) if u < 0.5 else 2 - math.log(1 - u)  # starting points; both halves are convex
        for _ in range(60):
            x = max(x - (1 - (1 + x) * math.exp(-x) - u) / (x * math.exp(-x)), x / 8)
        out.append(x)
    return out


def draws() -> tuple[list[float], list[float]]:
    """The values of r by 12 bits, and of ln c by 12 bits, then by 12 more for the lowest of those cells."""
    middle = [(i + 0.5) / CELLS for i in range(CELLS)]
    r = gamma_quantiles(middle)
    return r, [math.log(x) for x in r] + [math.log(x) for x in gamma_quantiles([u / CELLS for u in middle])]


def _sample(k: int) -> Column:
    """Value (high half) and identity (24 bits of the term, 8 of t; low half) of a term for sample k."""
    h = f"xxhash64(term, {k})"
    r = f"gammas[cast({h} & {CELLS - 1}L as int)]"
    high, low = f"(shiftright({h}, 12) & {CELLS - 1}L)", f"(shiftright({h}, 24) & {CELLS - 1}L)"
    log_c = f"log_gammas[cast(if({high} = 0L, {CELLS}L + {low}, {high}) as int)]"
    b = f"(((shiftright({h}, 36) & 16383L) + 0.5D) * {2.0**-14!r}D)"
    t = f"floor(log_weight / {r} + {b})"
    value = f"floor(({log_c} - {r} * ({t} - {b} + 1) + {_OFFSET}D) * {_SCALE}D)"
    return F.expr(f"shiftleft({value}, 32) | shiftleft(term & {(1 << 24) - 1}L, 8) | ({t} & 255L)")


def signatures(weights: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """keys and signature (array of samples / 4 longs; null without terms) of weighted terms."""
    spark = weights.sparkSession
    # two columns of one value: as scalar subqueries they are not copied into all expressions
    tables = [spark.range(1).select(F.split(F.lit(",".join(map(repr, x))), ",").cast("array<double>")).scalar() for x in draws()]
    best = (weights.withColumn("log_weight", F.ln("weight")).withColumn("gammas", tables[0]).withColumn("log_gammas", tables[1])
            .groupBy(*keys).agg(*[F.min(_sample(k)).alias(f"s{k}") for k in range(samples)]))

    def lane(k: int) -> Column:
        s = F.col(f"s{k}")
        return F.shiftleft(s.bitwiseXOR(F.shiftrightunsigned(s, 16)).bitwiseAND(F.lit(0xFFFF)), 16 * (k % LANES))

    packed = []
    for a in range(0, samples, LANES):
        one = lane(a)
        for k in range(a + 1, min(a + LANES, samples)):
            one = one.bitwiseOR(lane(k))
        packed.append(one)
    return best.select(*keys, F.when(F.col("s0").isNotNull(), F.array(*packed)).alias("signature"))


def fingerprint(signature: Column) -> Column:
    """The hexadecimal form, 4 digits a sample; empty without terms."""
    return F.coalesce(F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples of two signatures."""
    def equal(x: Column) -> Column:
        lanes = [F.when(F.shiftrightunsigned(x, 16 * i).bitwiseAND(F.lit(0xFFFF)) == 0, 1).otherwise(0) for i in range(LANES)]
        return lanes[0] + lanes[1] + lanes[2] + lanes[3]

    same = F.aggregate(F.zip_with(a, b, lambda x, y: equal(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    filler = -samples % LANES  # lanes without a sample are equal
    return (F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0)
            .otherwise((same - filler) / float(samples)))


def _identified(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a key that holds no null: (slot, key)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("slot"),
                       F.xxhash64(F.col("doc_id").isNull(), text).alias("key"), F.col("doc_id").isNull().alias("unnamed"),
                       text.alias("text"))


def chain(rows: DataFrame) -> DataFrame:
    """Each document (slot, key) of ``_identified`` rows, its n_chars and number of copies, with the
    next one (next_slot, next_key) in descending doc_id."""
    spark = rows.sparkSession
    light = rows.groupBy("slot", "key", "unnamed").agg(F.max(F.length("text")).cast("long").alias("n_chars"),
                                                       F.count(F.lit(1)).alias("copies"))
    order = [F.col("unnamed"), F.col("slot").desc(), F.col("key")]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    light = keep(light.repartitionByRange(ranges, *order).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    here = F.struct("slot", "key")
    inner = light.withColumn("follows", F.lead(here).over(Window.partitionBy("part").orderBy(*order)))
    heads = light.groupBy("part").agg(F.min_by(here, F.struct("unnamed", F.bitwise_not("slot"), "key")).alias("head"))
    every = Window.orderBy("part")  # one row a range
    heads = heads.select(F.col("part").alias("head_part"), F.coalesce(
        F.lead("head").over(every), F.first("head").over(every)).alias("head"))
    after = F.coalesce("follows", "head")
    return inner.join(heads, F.col("part") == F.col("head_part")).select(
        "slot", "key", "unnamed", "n_chars", "copies", after.getField("slot").alias("next_slot"),
        after.getField("key").alias("next_key"))


def edited_pairs(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document, and of its text with the last half replaced from the next one.

    ``docs`` has doc_id and text. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    configure(docs.sparkSession)
    rows = _identified(docs)
    links = keep(chain(rows), "fingerprint-links")
    own = ["slot", "key"]
    texts = rows.groupBy(*own).agg(F.first("text").alias("text"))

    # the part of a text that goes to the document before it
    half = F.floor(F.col("n_chars") / 2).cast("int")
    wanted = links.select(F.col("slot").alias("of_slot"), F.col("key").alias("of_key"), half.alias("half"),
                          F.col("next_slot").alias("slot"), F.col("next_key").alias("key"))
    heads = texts.join(wanted, own).select(F.col("of_slot").alias("slot"), F.col("of_key").alias("key"),
                                           F.expr("left(text, half)").alias("head"))
    both = texts.join(heads, own)
    cut = F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))")
    both = both.select(*own, "text", F.concat(cut, "head").alias("edited"))
    both = both.select(*own, F.explode(F.array(F.struct(F.lit(None).cast("binary").alias("sha"), F.col("text")),
                                               F.struct(F.unhex(F.sha2("edited", 256)).alias("sha"), F.col("edited").alias("text")))).alias("t"))
    keys = [*own, "sha"]
    signed = signatures(term_weights(both.select(*own, "t.sha", "t.text"), keys), keys, samples)
    is_own = F.col("sha").isNull()
    signed = keep(signed.groupBy(*own).agg(
        F.max("sha").alias("sha"), F.max(F.when(is_own, F.col("signature"))).alias("signature"),
        F.max(F.when(~is_own, F.col("signature"))).alias("edited")), "fingerprint-signed")

    following = signed.select(F.col("slot").alias("next_slot"), F.col("key").alias("next_key"), F.col("signature").alias("next"))
    out = links.join(signed, own).join(following, ["next_slot", "next_key"])
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES)))
    out = out.withColumn("block", block).withColumn("copy", F.explode(F.sequence(
        F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("block") * COPIES))))
    mine, edited = F.col("signature"), F.col("edited")
    return out.select(F.when(~F.col("unnamed"), F.col("slot")).alias("doc_id"), "n_chars",
                      F.lower(F.hex("sha")).alias("edited_sha256"), fingerprint(mine).alias("fingerprint"),
                      fingerprint(edited).alias("edited_fingerprint"), likeness(mine, edited, samples).alias("near_edited"),
                      likeness(mine, F.col("next"), samples).alias("near_next"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the whole documents table."""
    return edited_pairs(table(spark, sf_dir, "documents", "doc_id", "text"))
