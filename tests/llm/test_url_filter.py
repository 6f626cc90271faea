import pytest
import xxhash

from tallyloom.llm import url_filter
from tallyloom.llm.queries import RULES

URLS = [
    None, "", "example.org/es/1", "http://example.org/es/1", "HTTP://Example.ORG/es/1", "http://a.example.org/es/", "http://notexample.org/es/1",
    "http://example.org/en/1", "http://example.org/en/12?x=/fr/", "http://example.org/en/2", "http://x.com/fr/a", "http://x.com/de/a#b", "http://x.com",
    "http://x.com?a/de/", "ftp://com/de/", "http://x.net/en/", "http://x.org", "http://x.org/", "http://É.com/de/", "://org/", "http://x.org/" + "p" * 100_000,
]


def brute(url):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for verdict, rule in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return (host, path, best[1] if best else None, best[0] if best else "allow")


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, u, "x", 0) for i, u in enumerate([*URLS, URLS[3]])], "page_id long, url string, host string, rule int")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge(df, RULES).collect()}
    assert got == {i: brute(u) for i, u in enumerate([*URLS, URLS[3]])}


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: brute(r.url) for r in pages.collect()}
    assert {r.page_id: tuple(r)[1:] for r in url_filter.judge(pages, RULES).collect()} == want


def test_empty_table_and_no_rules(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert tuple(url_filter.judge(one, []).first()) == (1, "a.b", "/c", None, "allow")


def test_a_collision_is_confirmed_against_the_string(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda s: 7)
    data, _ = url_filter.digest_array([("block", "a.b/"), ("allow", "c.d/")])
    monkeypatch.undo()
    (tmp_path / "i").write_bytes(data)
    index = url_filter.DigestArray(str(tmp_path / "i"))
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda s: 7)
    assert index.find([b"a.b/", b"c.d/", b"e.f/"]) == ["block", "allow", None]


def test_refused(spark):
    with pytest.raises(ValueError):
        url_filter.digest_array([("deny", "a/")])
    with pytest.raises(ValueError):
        url_filter.digest_array([("allow", "a/")], max_bytes=10)
