"""Language ID (9): rank-order n-gram profiles and the out-of-place distance.

A profile is the list of a language's most frequent character n-grams (1 to 3 characters, over
lower-cased words with a blank on either side), most frequent first. A document's own list is
compared with each profile: every n-gram of the document costs the difference of its two ranks,
or the profile's length if the profile lacks it. The smallest sum wins (ties: the smaller name).

Profiles count every training text in whole. Only the ``size`` first n-grams of each language
reach the driver, and at most ``max_languages`` languages are accepted.

Null or letterless texts get ``und`` and score 0; so does every text if there is nothing to learn
from. Null languages are not learned from. A null doc_id counts as the empty text in the split.
Repeated rows are separate rows. Further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillbook.llm.common import sliced, table

PROFILE = 400
DOC_GRAMS = 300
MAX_LANGUAGES = 1000
UNDETERMINED = "und"
SPACE = 32
SLICE_BYTES = 1 << 20


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


def counted_grams(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct n-gram codes (21 bits a character), ascending, and their counts."""
    low = ["" if t is None else t.lower() for t in texts.to_pylist()]
    sizes = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    chars = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    doc = np.append(np.repeat(np.arange(len(low)), sizes), len(low))
    chars = np.where(_letters()[chars], chars, SPACE)
    real = np.ones(len(chars), bool)
    real[1:] = (chars[1:] != SPACE) | (chars[:-1] != SPACE) | (doc[1:] != doc[:-1])
    chars, doc = chars[real], doc[real]
    blank = chars == SPACE
    codes, owner = [], []
    one = ~blank
    codes.append(chars[one])
    owner.append(doc[one])
    pair = ~(blank[:-1] & blank[1:])
    two = chars[:-1] | chars[1:] << 21
    codes.append(two[pair])
    owner.append(doc[:-1][pair])
    triple = ~blank[1:-1]
    three = two[:-1] | chars[2:] << 42
    codes.append(three[triple])
    owner.append(doc[:-2][triple])
    ends = [np.searchsorted(o, np.arange(len(low) + 1)) for o in owner]
    out = []
    for k in range(len(low)):
        mine = np.sort(np.concatenate([c[e[k]:e[k + 1]] for c, e in zip(codes, ends, strict=True)]))
        first = np.flatnonzero(np.concatenate(([True], mine[1:] != mine[:-1]))) if len(mine) else np.empty(0, np.int64)
        out.append((mine[first], np.diff(np.append(first, len(mine)))))
    return out


def _merge(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, where = np.unique(np.concatenate(codes), return_inverse=True)
    return every, np.bincount(where, weights=np.concatenate(counts), minlength=len(every)).astype(np.int64)


def _count_by_language(batches):
    held: dict[str, tuple[list, list]] = {}
    for batch in sliced(batches, "text", SLICE_BYTES):
        for lang, (codes, counts) in zip(batch.column("lang").to_pylist(), counted_grams(batch.column("text")), strict=True):
            own = held.setdefault(lang, ([], []))
            own[0].append(codes)
            own[1].append(counts)
        for lang, own in held.items():
            codes, counts = _merge(*own)
            held[lang] = ([codes], [counts])
    for lang, ((codes,), (counts,)) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)],
                                         names=["lang", "gram", "n"])


def learn(labelled: DataFrame, size: int = PROFILE, max_languages: int = MAX_LANGUAGES) -> dict[str, np.ndarray]:
    """Profiles from (text, lang): the ``size`` most frequent n-grams of each language, in rank order."""
    counts = (labelled.select("text", "lang").where("text is not null and lang is not null")
              .mapInArrow(_count_by_language, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = counts.withColumn("rank", rank).where(F.col("rank") <= size).toArrow()
    langs = sorted(pc.unique(rows.column("lang")).to_pylist())
    if len(langs) > max_languages:
        raise ValueError(f"{len(langs)} languages; max_languages is {max_languages}")
    out = {}
    for lang in langs:
        mine = rows.filter(pc.equal(rows.column("lang"), lang)).sort_by("rank")
        out[lang] = mine.column("gram").to_numpy()
    return out


def _predictor(profiles: dict[str, np.ndarray], top: int, columns: tuple[str, ...]):
    size = max((len(p) for p in profiles.values()), default=1)
    grams = np.unique(np.concatenate([*profiles.values(), np.empty(0, np.int64)]))
    ranks = np.full((len(profiles), len(grams) + 1), -1, np.int64)  # the last column: n-grams of no profile
    for k, p in enumerate(profiles.values()):
        ranks[k, np.searchsorted(grams, p)] = np.arange(len(p))
    names = list(profiles)

    def guess(codes: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(codes) or not names:
            return UNDETERMINED, 0.0
        own = codes[np.lexsort((codes, -counts))[:top]]
        at = np.searchsorted(grams, own)
        at[(at == len(grams)) | (grams[np.minimum(at, len(grams) - 1)] != own)] = len(grams)
        there = ranks[:, at]
        cost = np.where(there < 0, size, np.minimum(np.abs(there - np.arange(len(own))), size)).sum(axis=1)
        best = int(np.argmin(cost))
        return names[best], 1 - float(cost[best]) / (size * len(own))

    def run(batches):
        for batch in sliced(batches, "text", SLICE_BYTES):
            got = [guess(*x) for x in counted_grams(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in columns), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=[*columns, "lang_pred", "score"])
    return run


def predict(texts: DataFrame, profiles: dict[str, np.ndarray], columns: tuple[str, ...] = (),
            top: int = DOC_GRAMS) -> DataFrame:
    """The given columns of ``texts`` (a DataFrame with a column text) with lang_pred and score."""
    fields = [f"`{n}` {texts.schema[n].dataType.simpleString()}" for n in columns]
    used = texts.select(*columns, *([] if "text" in columns else ["text"]))
    return used.mapInArrow(_predictor(profiles, top, columns), ", ".join([*fields, "lang_pred string", "score double"]))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is never learned from: crc32 of its id as text leaves 1 by 3."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def classify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict all: doc_id, held_out, lang_pred, score."""
    split = docs.select("doc_id", held_out().alias("held_out"), "text", "lang")
    profiles = learn(split.where("not held_out"))
    return predict(split, profiles, ("doc_id", "held_out"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the whole documents table."""
    return classify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
