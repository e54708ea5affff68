"""The query against its DuckDB twin, both ways against a plain judge, collisions, and odd urls."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from oracle import compare, duck
from tillbook.llm import url_filter

URLS = ["http://a.com/x", "https://WWW.Example.COM/en/1?q#f", "http://example.com/en", "http://example.com/en/", "http://example.com.net/es/",
        "http://notexample.com/en/x", "http://com", "http://com/", "http://.com/", "no scheme", "", None, "://net/fr/?x", "http://a.net/FR/",
        "http://é.net/fr/ü", "http://a/?x=://net/es/", "ftp://u@x.example.com:80/en/", "http://x..com/", "http://www.example.com/en/deep/er"]


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda x: (x[0], x[1], x[3] == "block"), default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def test_oracle(spark):
    ok, msg = compare(spark, "op7_url_filter", url_filter.query, url_filter.oracle(), SF_SMALL, duck(SF_SMALL))
    assert ok, msg


def test_both_ways_match_the_plain_judge(spark):
    rules = [*url_filter.RULES, ("é.net", "/fr/ü", "block"), ("example.com", "/en/", "allow"), ("b.c", "/xyz", "block"), ("a.b.c", "/x", "allow")]
    urls = [*URLS, "http://a.b.c/xyz", "http://a.b.c/x", "http://b.c/xyz"]
    pages = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate([*urls, *urls])], "page_id long, url string, rule string, verdict string")
    listed = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, verdict string")
    want = [(i, *plain(u, rules)) for i, u in enumerate([*urls, *urls])]
    for limit in (url_filter.MAX_RULE_BYTES, 0):
        got = url_filter.judge(pages, listed, max_rule_bytes=limit).select("page_id", "host", "path", "rule", "verdict").collect()
        assert sorted(map(tuple, got)) == want


@given(st.lists(st.tuples(st.text("ab.", max_size=4), st.text("/a", max_size=3), st.sampled_from(["allow", "block"])), max_size=20),
       st.lists(st.tuples(st.text("ab.", max_size=4), st.text("/a", max_size=3)), max_size=20))
@settings(max_examples=60, deadline=None)
def test_array_confirms_full_texts(tmp_path_factory, rules, probes):
    path = str(tmp_path_factory.mktemp("d") / "x")
    url_filter.build(rules, path)
    array = url_filter.Digests(path)
    # all keys alike: only the stored texts tell the rules apart
    found = array.find([h for h, _ in probes], [p for _, p in probes])
    for (h, p), k in zip(probes, found.tolist(), strict=True):
        own = {v for a, b, v in rules if (a, b) == (h, p)}
        assert (k >= 0) == bool(own)
        if own:
            assert bool(array.allow[k]) == ("block" not in own)


def test_collisions_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda _: 7)
    rules = [(f"h{k}", "/", "block" if k % 2 else "allow") for k in range(9)]
    url_filter.build(rules, str(tmp_path / "x"))
    array = url_filter.Digests(str(tmp_path / "x"))
    hosts = [f"h{k}" for k in range(12)]
    found = array.find(hosts, ["/"] * 12)
    assert [bool(array.allow[k]) for k in found[:9]] == [k % 2 == 0 for k in range(9)] and (found[9:] == -1).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_filter.judge(pages, none).select("rule", "verdict").collect() == [(None, "allow")]
    assert url_filter.judge(pages.where("page_id = 2"), none).count() == 0
