"""Benchmark decontamination (10): n-gram seeds, then Smith-Waterman alignment, in one pass over the texts.

1. Every three-word window of the test items is a seed, however frequent. Each occurrence in a
   training text gives a candidate passage: the stretch of the text along the diagonal of the hit,
   as long as the item plus a margin on both sides.
2. Bounds, both exact: an alignment that reaches ``MIN_SCORE`` inserts at most
   2 * (1 - MIN_SCORE) * length words, which is the margin; and it matches at least
   MIN_SCORE * length of the item's words, so a passage that holds fewer of them is dropped.
3. Each passage that is left is aligned with its item, word by word, by the Smith-Waterman recurrence
   (match 2, mismatch -1, gap -1). The score is divided by that of a full copy. Pairs that reach
   ``MIN_SCORE`` are contaminated.

So an alignment that reaches ``MIN_SCORE`` and holds a window of its item unchanged is found with
its full score, wherever else the item has leaked to. One without such a window is not looked for.

Only the items' windows and words are sent to the tasks, in blocks of items of at most
``BLOCK_WORDS`` words; a larger benchmark takes several passes. Texts are not shuffled.

Result: one row per contaminated document row and item: doc_id, item_id, score (of its best
passage) and the passage's words [from_word, to_word). Ties go to the earlier passage. Items of
fewer than three words have no seeds and match nothing; null or empty texts neither. Rows that
repeat a doc_id are judged on their own; repeated items give one row each. Further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.llm.common import keep, ngrams, sliced, table, text_key, without, word_hashes
from tillbook.session import configure

WORDS = 3
MIN_SCORE = 0.5
BLOCK_WORDS = 2_000_000
HITS = 1 << 20  # pairs of a hit and an item that a task expands at a time
MATCH, MISMATCH, GAP = 2, -1, -1
_FOUND = "doc_id long, text_key long, item_id long, score double, from_word long, to_word long"


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> np.ndarray:
    """Smith-Waterman scores of pairs of word arrays, all pairs advancing together."""
    m, n = max(map(len, items)), max(map(len, passages))
    a, b = np.zeros((len(items), m), np.uint64), np.zeros((len(items), n), np.uint64)
    real_a, real_b = np.zeros(a.shape, bool), np.zeros(b.shape, bool)
    for k, (x, y) in enumerate(zip(items, passages, strict=True)):
        a[k, :len(x)], real_a[k, :len(x)] = x, True
        b[k, :len(y)], real_b[k, :len(y)] = y, True
    row = np.zeros((len(items), n + 1), np.int32)
    slope = -GAP * np.arange(n + 1, dtype=np.int32)
    best = np.zeros(len(items), np.int32)
    for i in range(m):
        hit = (b == a[:, i:i + 1]) & real_b & real_a[:, i:i + 1]
        step = np.maximum(row + GAP, 0)
        step[:, 1:] = np.maximum(step[:, 1:], row[:, :-1] + np.where(hit, MATCH, MISMATCH))
        # a run of gaps along the passage: the best earlier cell less the distance to it
        row = np.maximum.accumulate(step + slope, axis=1) - slope
        row = np.where(real_a[:, i:i + 1], row, 0)
        best = np.maximum(best, row.max(axis=1))
    return best


def _windows(width: int):
    def run(batches):
        for batch in sliced(batches, "text"):
            words, offsets = word_hashes(batch.column("text"))
            for k, item in enumerate(batch.column("item_id").to_pylist()):
                own = words[offsets[k]:offsets[k + 1]]
                grams = ngrams(own, width).view(np.int64) if len(own) >= width else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item], pa.int64()), pa.array([batch.column("number")[k].as_py()], pa.int64()),
                     pa.array([own.view(np.int64)], pa.list_(pa.int64())), pa.array([grams], pa.list_(pa.int64()))],
                    names=["item_id", "number", "words", "grams"])
    return run


class Items:
    """A block of items: the words of each, and for each distinct window the (item, offset) it occurs at."""

    def __init__(self, ids: list, words: list[np.ndarray], grams: list[np.ndarray]):
        self.ids, self.words = ids, words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        each = np.fromiter(map(len, grams), np.int64, len(grams))
        flat = np.concatenate(grams)
        order = np.argsort(flat, kind="stable")
        self.grams, self.first, self.times = np.unique(flat[order], return_index=True, return_counts=True)
        self.item = np.repeat(np.arange(len(words)), each)[order]
        self.offset = (np.arange(len(flat)) - np.repeat(np.cumsum(each) - each, each))[order]

    def lanes(self, hit: np.ndarray, place: np.ndarray, doc: np.ndarray, grid: np.ndarray) -> np.ndarray:
        """Distinct (doc, item, lane) rows of hits: windows ``hit`` at the ``place`` of a ``doc``."""
        upto = np.cumsum(self.times[hit])
        out, a = np.empty((0, 3), np.int64), 0
        while a < len(hit):  # about HITS pairs at a time
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + HITS, "right")))
            n = self.times[hit[a:b]]
            at = np.repeat(self.first[hit[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            item = self.item[at]
            lane = (np.repeat(place[a:b], n) - self.offset[at]) // grid[item]
            out = np.concatenate((out, np.stack((np.repeat(doc[a:b], n), item, lane), axis=1)))
            out = out[np.lexsort(out.T[::-1])]
            out = out[np.concatenate(([True], (out[1:] != out[:-1]).any(axis=1)))]
            a = b
        return out


def _score(items: Items, width: int, min_score: float, cells: int = 100_000):
    def run(batches):
        grid = np.maximum(items.length // 2, 1)
        margin = np.ceil(2 * items.length * (1 - min_score)).astype(np.int64)
        least = np.ceil(min_score * items.length - 1e-9).astype(np.int64)  # words an alignment has to match
        for batch in sliced(batches, "text"):
            words, offsets = word_hashes(batch.column("text"))
            if len(words) < width:
                continue
            own = ngrams(words, width).view(np.int64)
            at = np.minimum(np.searchsorted(items.grams, own), len(items.grams) - 1)
            places = np.flatnonzero(items.grams[at] == own)
            doc = np.searchsorted(offsets, places, "right") - 1
            inside = places + width <= offsets[doc + 1]
            places, doc = places[inside], doc[inside]
            todo = []
            for k, number, lane in items.lanes(at[places], places - offsets[doc], doc, grid).tolist():
                low, high = int(offsets[k]), int(offsets[k + 1])
                first = max(lane * int(grid[number]) - int(margin[number]), 0)
                last = min((lane + 1) * int(grid[number]) + int(items.length[number] + margin[number]), high - low)
                if np.isin(items.words[number], words[low + first:low + last]).sum() >= least[number]:
                    todo.append((k, number, first, last))
            best: dict[tuple[int, int], tuple] = {}
            todo.sort(key=lambda t: (len(items.words[t[1]]), t[3] - t[2]))
            c = 0
            while c < len(todo):  # pairs of like length together, their passages of ``cells`` words in all
                some = todo[c:c + max(1, cells // max(1, 4 * len(items.words[todo[c][1]])))]
                c += len(some)
                got = align([items.words[t[1]] for t in some], [words[offsets[t[0]] + t[2]:offsets[t[0]] + t[3]] for t in some])
                for (k, number, first, last), value in zip(some, got.tolist(), strict=True):
                    score = value / (MATCH * len(items.words[number]))
                    rank = (-score, first, last)
                    if score >= min_score and rank < best.get((k, number), (1,)):
                        best[k, number] = rank
            rows = sorted((k, number, *rank) for (k, number), rank in best.items())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n).take(pa.array([r[0] for r in rows], pa.int64())) for n in ("doc_id", "text_key")),
                 pa.array([items.ids[r[1]] for r in rows], pa.int64()), pa.array([-r[2] for r in rows], pa.float64()),
                 pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64())],
                names=["doc_id", "text_key", "item_id", "score", "from_word", "to_word"])
    return run


def find(docs: DataFrame, benchmark: DataFrame, width: int = WORDS, min_score: float = MIN_SCORE,
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """Contaminated (document, item) pairs of ``docs`` (doc_id, text) and ``benchmark`` (item_id, text)."""
    spark = configure(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_key().alias("text_key"))
    numbered = benchmark.select("item_id", "text", F.monotonically_increasing_id().alias("number"))
    items = keep(numbered.mapInArrow(_windows(width), "item_id long, number long, words array<long>, grams array<long>")
                 .where(F.size("grams") > 0), "decon-items")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // block_words)
    out = None
    for k in range(blocks):
        found = _block(texts, items.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == k), width, min_score)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], _FOUND)
    return out


def _block(texts: DataFrame, items: DataFrame, width: int, min_score: float) -> DataFrame:
    ids, words, grams = [], [], []
    for r in items.toLocalIterator():  # at most BLOCK_WORDS words
        ids.append(r.item_id)
        words.append(np.array(r.words, np.int64).view(np.uint64))
        grams.append(np.array(r.grams, np.int64))
    if not ids:
        return texts.sparkSession.createDataFrame([], _FOUND)
    return texts.mapInArrow(_score(Items(ids, words, grams), width, min_score), _FOUND)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows."""
    leaks = find(docs, benchmark, **options).select(F.col("doc_id").alias("its_id"), F.col("text_key").alias("its_key")).distinct()
    return without(docs, keep(leaks, "decon-leaks"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the whole documents table against the whole benchmark table."""
    return find(table(spark, sf_dir, "documents", "doc_id", "text"),
                table(spark, sf_dir, "benchmark", "item_id", "text")).drop("text_key")
