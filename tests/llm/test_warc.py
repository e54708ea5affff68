"""The query against its DuckDB twin, round trips of payloads, revisits, and odd inputs."""

from collections import Counter

from conftest import SF_SMALL
from oracle import compare, duck
from tillbook.llm import warc


def test_oracle(spark):
    ok, msg = compare(spark, "op6_warc", warc.query, warc.ORACLE, SF_SMALL, duck(SF_SMALL))
    assert ok, msg


def captures(spark, rows, tmp_path, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record_type string").repartition(2)
    warc.write(df, str(tmp_path / "w"), **options)
    return warc.assemble(warc.read(spark, str(tmp_path / "w"))).collect()


def test_payloads_survive_and_copies_are_revisits(spark, tmp_path):
    tricky = "a\r\n\r\nWARC/1.1\r\nContent-Length: 7\r\n\r\n é ☃ \0" * 40
    rows = [(1, "http://a/\r\nb", tricky), (2, "http://b", tricky), (5, None, tricky), (3, "http://c", "short"), (4, "http://d", "short")]
    got = {r.page_id: r for r in captures(spark, rows, tmp_path, file_bytes=2000)}
    assert {k: (r.record_type, r.refers_to) for k, r in got.items()} == {
        1: ("revisit", 5), 2: ("revisit", 5), 5: ("response", None), 3: ("response", None), 4: ("response", None)}
    assert bytes(got[5].capture.payload) == tricky.encode() and bytes(got[3].capture.payload) == b"short"
    assert {got[k].payload_bytes for k in (1, 2, 5)} == {len(tricky.encode())}
    assert len({got[k].payload_digest for k in (1, 2, 5)}) == 1
    assert got[1].request.target_uri == got[1].capture.target_uri == "http://a/%0D%0Ab"
    assert got[5].request.target_uri is None


def test_files_are_whole_archives(spark, tmp_path):
    rows = [(k, f"http://h/{k}", f"page {k} " * k) for k in range(40)]
    captures(spark, rows, tmp_path, file_bytes=4000)
    files = list((tmp_path / "w").glob("part-*"))
    assert len(files) > 4
    kinds = Counter(r["record_type"] for f in files for r in warc._parse(f.read_bytes(), False))
    assert kinds == {"request": 40, "response": 40, "metadata": 40}


def test_odd_inputs(spark, tmp_path):
    big = "y" * 1000
    rows = [(1, "u", None), (2, "u", ""), (None, "u", big), (7, "u", big), (7, "u", big), (8, "u", "z" * 2_000_000), (None, "v", "w" * 1500),
            (None, "v", "w" * 1500)]
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in captures(spark, rows, tmp_path))
    assert got == {(1, 0, "response", None): 1, (2, 0, "response", None): 1, (None, 1000, "revisit", 7): 1,
                   (7, 1000, "response", None): 2, (8, 2_000_000, "response", None): 1, (None, 1500, "response", None): 2}


def test_empty_table(spark, tmp_path):
    assert captures(spark, [], tmp_path) == []
