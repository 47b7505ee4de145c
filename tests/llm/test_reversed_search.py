import random
import re
from collections import Counter
from math import floor, log

import duckdb
import pytest

from playmart.llm import reversed_search
from playmart.llm.common import table
from playmart.llm.queries import ORACLE, QUERIES

from .conftest import SF

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n, length = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    wanted: dict = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for doc, c, size in counted:
            m = 10 + (90 * size * n) // length
            s = sum(
                floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t]
            )
            if s > 0:
                scored.append((-s, doc is None, doc, s))
        out += [(item, r, doc, s) for r, (_, _, doc, s) in enumerate(sorted(scored, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=repr)


def test_terms_are_the_matches():
    text = "Ünder_score A-Z, naïve ÉCOLE x\x00y 日本 1a2B\x7f[end]"
    assert [t.decode() for t in reversed_search.terms(text.encode())] == terms(text)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_against_brute_force(spark, docs_of, monkeypatch, block_bytes):
    monkeypatch.setattr(reversed_search, "CHUNK_TERMS", 200)
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "日本", "X1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = [text(rng.choice([1, 5, 30])) for _ in range(120)]
    texts += ["", None, " .,;-", texts[0], texts[0], "W1 w1. w1", "w1 " * 9000]
    ids = list(range(len(texts)))
    ids[3] = None
    ids[4] = 5  # an id twice
    items = [(i, text(rng.choice([1, 3, 12]))) for i in range(12)] + [(20, None), (21, "--"), (0, "w1 w2"), (22, "nowhere"), (None, "w3")]
    found = reversed_search.search(
        docs_of(texts, ids=ids), spark.createDataFrame(items, "item_id long, text string").withColumnsRenamed({}), block_bytes=block_bytes
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted(map(tuple, found.collect()), key=repr)
    expected = brute(list(zip(ids, texts)), items)
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in expected]
    assert got == expected


def test_empty_tables(spark, docs_of):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string, rank int")
    assert reversed_search.search(docs_of([]), items).count() == 0
    assert reversed_search.search(docs_of(["", None]), items).count() == 0
    assert reversed_search.search(docs_of(["a"]), none).count() == 0
    clash = items.selectExpr("*", "1 AS rank", "2 AS score", "3 AS doc_id")
    assert [tuple(r)[:3] for r in reversed_search.search(docs_of(["a c", "d e f"]), clash).collect()] == [(1, 1, 0)]


def test_query_against_its_oracle(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    name = "op12_reversed_search"
    assert sorted(map(tuple, QUERIES[name](spark, SF).collect())) == sorted(con.execute(ORACLE[name]).fetchall())
    assert table(spark, SF, "benchmark").count() > 0
