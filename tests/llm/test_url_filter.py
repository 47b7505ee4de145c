"""The automaton against a regular-expression reading of the globs."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from playmart.llm import url_filter
from playmart.llm.queries import ORACLE, QUERIES

from .conftest import SF


def as_regex(glob: str) -> re.Pattern:
    out, i = "", 0
    while i < len(glob):
        if glob[i : i + 2] == "**":
            out, i = out + ".*", i + 2
        elif glob[i] == "*":
            out, i = out + "[^/]*", i + 1
        elif glob[i] == "?":
            out, i = out + "[^/]", i + 1
        elif glob[i] == "\\" and i + 1 < len(glob):
            out, i = out + re.escape(glob[i + 1]), i + 2
        else:
            out, i = out + re.escape(glob[i]), i + 1
    return re.compile(out, re.S)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.text("ab/*?\\", max_size=9), min_size=1, max_size=30),
    st.lists(st.text("ab/", max_size=12), max_size=12),
)
def test_globs(globs, texts):
    hit = url_filter.GlobSet(globs).match([t.encode() for t in texts])
    for i, t in enumerate(texts):
        for j, g in enumerate(globs):
            assert hit[i, j] == bool(as_regex(g).fullmatch(t)), (g, t)


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for v, h, p in url_filter.SITE_RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (v, h + p)
    if best:
        return host, path, best[1], best[0]
    spam = any(as_regex(g).fullmatch(host + path) for g in url_filter.BLOCK_GLOBS)
    return host, path, None, "block" if spam else "allow"


URLS = [
    None, "", "no scheme.com/", "http://", "http://com/", "http://a.com", "http://A.Com/x", "x://www.Example.com/en/1",
    "x://m.example.com/en/1", "x://example.com/en", "x://notexample.com/en/1", "x://a.net/es/b", "x://a.net/esb", "x://net/fr/?q",
    "x://cheap-pills.org/a", "x://cheap-pills.org", "x://a.org/x.com/", "x://a.org#/spam/", "x://a.org/spam/x", "x://a?b://c/d", "x://ÀÉ.com/é\n/",
    "x://.com/", "x://y.com/" + "z" * 20000, "x://y.com/",  "x://y.com/",
]


def test_urls(spark):
    pages = spark.createDataFrame([(i, u, "h", i) for i, u in enumerate(URLS)], "page_id long, url string, html string, rule long")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge(pages).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}
    assert url_filter.judge(pages.limit(0)).count() == 0
    none = {r.page_id: r.verdict for r in url_filter.judge(pages, rules=[], block_globs=[]).collect()}
    assert set(none.values()) == {"allow"}


def test_query_matches_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    res = con.execute(ORACLE["op4_url_automaton"])
    cols = [d[0] for d in res.description]
    got = QUERIES["op4_url_automaton"](spark, SF).select(cols)
    assert sorted(map(tuple, got.collect())) == sorted(res.fetchall()) or sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(str, con.execute(ORACLE["op4_url_automaton"]).fetchall())
    )
