"""The store against a plain encoder, its planes as exact round trips, and odd inputs."""

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF_SMALL
from tillbook.llm import token_store as store


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.booleans())
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(ids, bits):
    x = np.array(ids, np.uint32)
    planes = store.to_planes(x, bits)
    assert len(planes) == (32 if bits else 4)
    assert (store.from_planes(planes, len(x)) == x).all()


def expected(rows):
    tok, start, out = Tokenizer.from_file(store.vocabulary()), 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_documents_match_plain_encoding(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in store.query(spark, SF_SMALL).orderBy("doc_id").collect()]
    assert got == expected(rows)


def test_odd_texts(spark):
    rows = [(5, None), (1, ""), (2, "  two  spaces \n\n and  more "), (3, "word " * 50_000), (4, "a  b"),
            (9, "x"), (7, "tab\t here"), (8, "don't stop — 12 345"), (None, "no id")]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, shard string").repartition(3)
    assert [tuple(r) for r in store.digests(df).orderBy("start").collect()] == expected(rows)


def test_special_token_literal(spark):
    mark = "<|endoftext|>"
    texts = [f"one {mark} two", mark, f"{mark} first", f"last {mark}", f"in{mark}side words", f"before{mark} and {mark}after it",
             f"{mark}{mark} {mark}", f"double  space {mark}\nline {mark}\t{mark}", f" {mark} ", f"broken <|endof text|> {mark[:-1]} >"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    assert 50256 in Tokenizer.from_file(store.vocabulary()).encode(texts[0], add_special_tokens=False).ids
    assert [tuple(r) for r in store.digests(df).orderBy("start").collect()] == expected(list(enumerate(texts)))


def test_repeated_rows_stay_apart(spark):
    df = spark.createDataFrame([(1, "same"), (1, "same"), (2, "other")], "doc_id long, text string")
    got = store.digests(df).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1, 1, 2]
    assert [r.start for r in got] == [0, got[0].n_tokens, 2 * got[0].n_tokens]


def test_empty_table(spark):
    assert store.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("bits", [False, True])
def test_small_blocks_and_chunks(spark, tmp_path, bits):
    rows = [(i, "some words and more of them " * (i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    store.write_store(df, str(tmp_path / "s"), block=16, chunk=40, bits=bits)
    got = store.read_store(spark, str(tmp_path / "s"), block=16).orderBy("doc_id").collect()
    assert [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in got] == expected(rows)
    index = spark.read.parquet(str(tmp_path / "s" / "index"))
    assert "payload" not in index.columns and index.count() > 10
