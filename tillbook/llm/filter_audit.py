"""Filter interaction audit (13): what each filter removes in every order, from sorted posting lists.

Every row gets a long id, dense within its input partition. For each part (a value of the part column),
filter and range of ``RANGE`` ids there is one posting list: the sorted ids of the rows that fail the
filter. A marked row (good, toxic) has posting lists of its own. The ids of a range are bounded, so a part
that holds most of the rows is spread over many ranges and tasks.

What an order of filters removes depends only on the sets of filters before and after each step. So each
range needs the sizes of the unions of all sets of filters: a union grows by one filter at a time, the
ids that the filter adds are found by galloping through the longer list, and the two runs are merged. The
sizes are sums over ranges, and all orders and steps are read off them.

Repeated rows count as often as they occur, also with the same doc_id. A null text is empty, a null part
is the empty string. A null doc_id is smaller and larger than no other, so such a row is never a copy nor
the reason for one. Of several labels of a doc_id any that marks it counts; a document without labels is
neither good nor toxic. A part without failing rows has zeros. Empty tables give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.llm.common import groups, keep, table
from tillbook.session import configure

# The failure conditions that the contract of op13 states.
SPACE = r"[\x20\x09-\x0D]+"
SIGNS = "[#$%&*|]"
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
UPPER_PERCENT = 5
NAMES = "ABCDE"

RANGE_BITS = 13  # posting lists cover 8,192 ids
GALLOP = 8  # lists that differ in length by this factor are probed, others merged


def failures(docs: DataFrame) -> DataFrame:
    """part, row, doc_id and fails (array of filter names) of every document; ``docs`` has doc_id, text, source."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, SPACE, -1), "")
    upper = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    own = {"A": F.size(words) < LEAST_WORDS,
           "B": 100 * F.size(F.array_distinct(words)).cast("long") < DISTINCT_PERCENT * F.size(words).cast("long"),
           "C": 100 * upper.cast("long") > UPPER_PERCENT * F.length(text).cast("long"),
           "D": text.rlike(SIGNS)}
    rows = keep(docs.select(F.col("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"),
                            F.monotonically_increasing_id().alias("row"), F.unhex(F.sha2(text, 256)).alias("key"),
                            *[c.alias(f"fails_{n}") for n, c in own.items()]), "audit-rows")
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = keep(first.where("last > first").select(F.col("key").alias("copied"), "first"), "audit-first")
    rows = rows.join(first, F.col("key") == F.col("copied"), "left").withColumn(
        "fails_E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    fails = F.array_compact(F.array(*[F.when(F.col(f"fails_{n}"), F.lit(n)) for n in NAMES]))
    return rows.select("part", "row", "doc_id", fails.alias("fails"))


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with marks (array of good, toxic) from ``labels`` (doc_id, quality, toxic)."""
    told = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("labelled")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    told = keep(told.where("good OR toxic"), "audit-labels")
    marks = F.array_compact(F.array(F.when(F.col("good"), F.lit("good")), F.when(F.col("toxic"), F.lit("toxic"))))
    return rows.join(told, F.col("doc_id") == F.col("labelled"), "left").select("part", "row", "fails", marks.alias("marks"))


def posting_lists(rows: DataFrame) -> DataFrame:
    """part, span, list (a filter or mark), ids: the sorted rows of every list in every range of ids.

    Rows that fail nothing are in no list that matters.
    """
    each = rows.where(F.size("fails") > 0).select(
        "part", F.shiftright("row", RANGE_BITS).alias("span"), "row", F.explode(F.concat("fails", "marks")).alias("list"))
    return each.groupBy("part", "span", "list").agg(F.sort_array(F.collect_list("row")).alias("ids"))


def added(ids: np.ndarray, union: np.ndarray) -> np.ndarray:
    """The ids that are not in ``union`` (both sorted, without repeats).

    If one list is much longer, the ids of the shorter one are sought in it; else both are merged.
    """
    if not len(ids) or not len(union):
        return ids
    if len(union) > GALLOP * len(ids):
        at = np.searchsorted(union, ids)
        return ids[union[np.minimum(at, len(union) - 1)] != ids]
    if len(ids) > GALLOP * len(union):
        at = np.searchsorted(ids, union)
        out = np.ones(len(ids), bool)
        out[at[(at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == union)]] = False
        return ids[out]
    return np.setdiff1d(ids, union, assume_unique=True)


def merged(union: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Two sorted runs without common ids as one; a stable sort of two runs is a galloping merge."""
    both = np.concatenate((union, new))
    both.sort(kind="stable")
    return both


def union_sizes(lists: dict[str, np.ndarray], names: str) -> np.ndarray:
    """For each set of filters (bit i: names[i]) the rows in the union of their lists: all, good and toxic ones."""
    none = np.empty(0, np.int64)
    good, toxic = lists.get("good", none), lists.get("toxic", none)
    unions = {0: none}
    sizes = np.zeros((1 << len(names), 3), np.int64)
    for mask in range(1, 1 << len(names)):
        last = mask.bit_length() - 1
        before = unions[mask ^ (1 << last)]
        new = added(lists.get(names[last], none), before)
        unions[mask] = merged(before, new) if len(new) else before
        sizes[mask] = sizes[mask ^ (1 << last)] + (len(new), len(new) - len(added(new, good)), len(new) - len(added(new, toxic)))
    return sizes


_SIZES = "part string, mask int, n long, good long, toxic long"


def _measure(names: str):
    def emit(part: str, sizes: np.ndarray) -> pa.RecordBatch:
        masks = np.arange(1, len(sizes))
        return pa.RecordBatch.from_arrays([pa.array([part] * len(masks), pa.string()), pa.array(masks, pa.int32()),
                                           *[pa.array(sizes[1:, j]) for j in range(3)]], names=["part", "mask", "n", "good", "toxic"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = None, None
        for group in groups(batches, ["part", "span"]):
            ids = group.column("ids")
            lists = {name: ids[i].values.to_numpy() for i, name in enumerate(group.column("list").to_pylist())}
            now = group.column("part")[0].as_py()
            if total is not None and now != part:
                yield emit(part, total)
                total = None
            sizes = union_sizes(lists, names)
            part, total = now, sizes if total is None else total + sizes
        if total is not None:
            yield emit(part, total)
    return run


def sizes_of_unions(postings: DataFrame, names: str = NAMES) -> DataFrame:
    """part, mask, n, good, toxic: the sizes of the unions of all sets of filters, in each part."""
    dealt = postings.repartition("part", "span").sortWithinPartitions("part", "span", "list")
    return dealt.mapInArrow(_measure(names), _SIZES).groupBy("part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def audit(rows: DataFrame, names: str = NAMES) -> DataFrame:
    """Every order of filters, step by step, in each part.

    ``rows`` has part, row (a unique long), fails (the filters it fails, of ``names``) and marks (good,
    toxic). Returns part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.
    """
    configure(rows.sparkSession)
    sizes = sizes_of_unions(keep(posting_lists(rows), "audit-postings"), names)
    found = sizes.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct(
        "mask", F.struct("n", "good", "toxic")))).alias("unions")).withColumnRenamed("part", "its_part")
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("total"))
    parts = parts.join(found, F.col("part") == F.col("its_part"), "left")

    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(names)])
    steps = parts.select("part", "total", "unions", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(names)))).alias("step"))
    bits = "aggregate(split({}, ''), 0, (m, c) -> m + int(if(c = '', 0, pow(2, instr('" + names + "', c) - 1))))"
    steps = steps.withColumn("letter", F.expr("substring(filter_order, step, 1)"))
    for name, letters in (("before", "substring(filter_order, 1, step - 1)"), ("after", "substring(filter_order, 1, step)"),
                          ("alone", "letter"), ("others", f"translate('{names}', letter, '')")):
        steps = steps.withColumn(name, F.expr(bits.format(letters)))

    def size(mask: str, of: str = "n") -> Column:
        return F.coalesce(F.get(F.array(F.element_at("unions", F.col(mask))), F.lit(0)).getField(of), F.lit(0).cast("long"))

    steps = steps.withColumn("every", F.lit((1 << len(names)) - 1)).withColumn("removed", size("after") - size("before"))
    own = Window.partitionBy("part", "letter")
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - size("after")).alias("kept"), "removed",
        (size("alone") - F.col("removed")).alias("redundant"), (size("every") - size("others")).alias("unique_fails"),
        (size("after", "good") - size("before", "good")).alias("good_lost"),
        (size("after", "toxic") - size("before", "toxic")).alias("toxic_lost"), F.sum("removed").over(own).alias("shapley"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: all 120 orders of the five filters over the whole documents table."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return audit(keep(marked(failures(docs), labels), "audit-marked"))


def oracle() -> str:
    """The same in DuckDB, from the flags of every document and order, without posting lists."""
    fails = "CASE letter " + " ".join(f"WHEN '{n}' THEN {n}" for n in NAMES) + " END"
    before = " OR ".join(f"({n} AND strpos(substr(filter_order, 1, step - 1), '{n}') > 0)" for n in NAMES)
    lone = f"({fails}) AND (" + " + ".join(f"CAST({n} AS INTEGER)" for n in NAMES) + ") = 1"
    cross = " ".join(f"JOIN l l{i} ON " + " AND ".join(f"l{i}.c <> l{j}.c" for j in range(1, i)) for i in range(2, len(NAMES) + 1))
    return f"""
WITH l(c) AS (VALUES {", ".join(f"('{n}')" for n in NAMES)}),
o AS (SELECT {" || ".join(f"l{i}.c" for i in range(1, len(NAMES) + 1))} AS filter_order FROM l l1 {cross}),
s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter
      FROM o, (SELECT unnest(range(1, {len(NAMES) + 1})) AS step)),
w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
m AS (SELECT body, min(doc_id) AS first FROM w GROUP BY body),
f AS (SELECT w.doc_id, part, len(words) < {LEAST_WORDS} AS A, 100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words) AS B,
             100 * len(regexp_replace(w.body, '[^A-Z]', '', 'g')) > {UPPER_PERCENT} * length(w.body) AS C,
             regexp_matches(w.body, '{SIGNS}') AS D, coalesce(w.doc_id > m.first, false) AS E
      FROM w JOIN m ON w.body = m.body),
g AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
      FROM labels GROUP BY doc_id),
r AS (SELECT part, filter_order, step, letter, ({fails}) AS fails, ({before}) AS gone, ({lone}) AS lone,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
      FROM f LEFT JOIN g ON f.doc_id = g.doc_id CROSS JOIN s),
c AS (SELECT part, filter_order, step, letter, count(*) FILTER (WHERE NOT gone AND NOT fails) AS kept,
             count(*) FILTER (WHERE fails AND NOT gone) AS removed, count(*) FILTER (WHERE fails AND gone) AS redundant,
             count(*) FILTER (WHERE lone) AS unique_fails, count(*) FILTER (WHERE fails AND NOT gone AND good) AS good_lost,
             count(*) FILTER (WHERE fails AND NOT gone AND toxic) AS toxic_lost
      FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM c
"""
