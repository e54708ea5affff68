"""The fingerprints against a plain computation of the same draws, the true similarity, and odd rows."""

import hashlib
import math
import re
import struct
from collections import Counter

import pytest
import xxhash

from conftest import SF_SMALL
from tillbook.llm import fingerprints as fp
from tillbook.llm.common import table


R, LOG_C = fp.draws()


def test_draws():
    """The tables are quantiles of Gamma(2, 1): mean 2, variance 2, and exact at a few points."""
    assert abs(sum(R) / 4096 - 2) < 2e-3 and abs(sum(x * x for x in R) / 4096 - 6) < 3e-2
    for i in (0, 7, 2000, 4095):
        assert abs(1 - (1 + R[i]) * math.exp(-R[i]) - (i + 0.5) / 4096) < 1e-12
        c = math.exp(LOG_C[4096 + i])
        assert abs(1 - (1 + c) * math.exp(-c) - (i + 0.5) / 4096**2) < 1e-12
    assert R == sorted(R) and LOG_C[4096:] == sorted(LOG_C[4096:]) and LOG_C[8191] < LOG_C[1]


def _hash(data: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain_signature(text):
    """The 64 samples of a text, term by term."""
    weights = Counter(_hash(w.encode(), 42) for w in words(text))
    if not weights:
        return None
    out = []
    for k in range(64):
        best = None
        for h, w in weights.items():
            first = _hash(struct.pack("<Q", h), 42)
            x = _hash(struct.pack("<i", k), first)
            high, low, b = x >> 12 & 4095, x >> 24 & 4095, ((x >> 36 & 16383) + 0.5) * 2.0**-14
            r, log_c = R[x & 4095], LOG_C[high or 4096 + low]
            t = math.floor(math.log(w) / r + b)
            value = math.floor((log_c - r * (t - b + 1) + 128) * 2**23)
            own = value << 32 | (h & 0xFFFFFF) << 8 | t & 255
            best = own if best is None else min(best, own)
        out.append((best ^ best >> 16) & 0xFFFF)
    return out


def plain_print(text):
    s = plain_signature(text)
    return "" if s is None else "".join("".join(f"{x:04x}" for x in reversed(s[a:a + 4])) for a in range(0, 64, 4))


def alike(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[i:i + 4] == b[i:i + 4] for i in range(0, 256, 4)) / 64


def brute_force(docs):
    """``docs``: (doc_id, text) with distinct ids, or rows that repeat both."""
    copies = Counter((i, t or "") for i, t in docs)
    order = sorted(copies, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b, c = plain_print(text), plain_print(edited), plain_print(following)
        row = (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, alike(a, b), alike(a, c))
        out += [row] * copies[i, text]
    return sorted(out, key=str)


def result(spark, docs):
    df = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, key int, sha string").repartition(3)
    return sorted(map(tuple, fp.edited_pairs(df.select("*")).collect()), key=str)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents", "doc_id", "text").collect()]
    got = sorted(map(tuple, fp.query(spark, SF_SMALL).collect()), key=str)
    assert got == brute_force(docs)


def test_odd_rows(spark):
    docs = [(9, None), (8, ""), (7, "?! ..."), (6, "one"), (5, "ÉÈ straße Über 12"), (4, "same words here"), (3, "same words here"),
            (2, "a b " * 30_000 + "c"), (-5, "😀 astral 😀 text of odd length"), (None, "no id at all"), (1, "rep eat"), (1, "rep eat"),
            (1, "rep eat"), (2**62, "large id")]
    got = result(spark, docs)
    assert got == brute_force(docs)
    prints = {r[0]: r[3] for r in got}
    assert prints[4] == prints[3] and prints[9] == prints[8] == prints[7] == ""


def test_same_id_other_texts(spark):
    """Texts of one doc_id: both are there, each the next of the other."""
    got = result(spark, [(1, "first text of two"), (1, "second one")])
    texts = {len("first text of two"): "first text of two", len("second one"): "second one"}
    for _, n, sha, *_ in got:
        own, other = texts[n], next(t for m, t in texts.items() if m != n)
        assert sha == hashlib.sha256((own[:n - n // 2] + other[:n // 2]).encode()).hexdigest()


def test_single_and_empty(spark):
    assert result(spark, []) == []
    assert result(spark, [(1, "just this")]) == brute_force([(1, "just this")])


def test_blocks_of_copies(spark, monkeypatch):
    monkeypatch.setattr(fp, "COPIES", 3)
    docs = [(1, "x y")] * 7 + [(2, "y z")] * 3 + [(3, "z")]
    assert result(spark, docs) == brute_force(docs)


@pytest.mark.parametrize("same", [10, 40, 80])
def test_collision_rate(spark, same):
    """Over many pairs the share of equal samples is the generalised Jaccard similarity."""
    rows, truth = [], 0.0
    for i in range(60):
        a = Counter({f"c{i}x{j}": 1 + j % 4 for j in range(same)}) + Counter({f"a{i}x{j}": 1 + j % 3 for j in range(100 - same)})
        b = Counter({f"c{i}x{j}": 1 + (j + i) % 4 for j in range(same)}) + Counter({f"b{i}x{j}": 2 for j in range(100 - same)})
        truth += sum((a & b).values()) / sum((a | b).values()) / 60
        rows += [(i, 0, " ".join(a.elements())), (i, 1, " ".join(b.elements()))]
    df = spark.createDataFrame(rows, "doc_id long, side int, text string")
    signed = fp.signatures(fp.term_weights(df, ["doc_id", "side"]), ["doc_id", "side"])
    a, b = (signed.where(f"side = {s}").select("doc_id", signed.signature.alias(f"s{s}")) for s in (0, 1))
    mean = a.join(b, "doc_id").select(fp.likeness(a.s0, b.s1).alias("x")).agg({"x": "avg"}).first()[0]
    assert abs(mean - truth) < 4 * math.sqrt(truth * (1 - truth) / 64 / 60)


def test_native_plan(spark):
    plan = fp.query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
