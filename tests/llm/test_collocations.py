import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from playmart.llm import collocations
from playmart.llm.queries import ORACLE, QUERIES

from .conftest import SF

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least=30, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inner = {
        (p[0], *p[1:][i : i + m])
        for p, a in cand.items()
        for m in range(2, len(p) - 1)
        for i in range(len(p) - m)
        if 100 * a >= 80 * f[(p[0], *p[1:][i : i + m])]
    }
    found: dict = {}
    for (lang, *w), a in cand.items():
        if (lang, *w) in inner:
            continue
        s, k = min((2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        found.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted(
        (lang, i, p.decode(), -a, left, right, n[lang], -s)
        for lang, rows in found.items()
        for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("bits", [32, 64])
def test_permutation_is_invertible(bits):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 1 << bits, 1000, np.uint64, endpoint=False) if bits < 64 else rng.integers(0, 1 << 63, 1000, np.uint64) for _ in "ab")
    hi, lo = collocations.permuted(a, b, bits=bits)
    assert (hi != a).any()
    x, y = collocations.permuted(hi, lo, back=True, bits=bits)
    assert (x == a).all() and (y == b).all()
    # sequential ids spread evenly over the leading bits
    n = 1 << 14
    top, _ = collocations.permuted(np.arange(n, dtype=np.uint64), np.zeros(n, np.uint64), bits=bits)
    assert np.bincount((top >> np.uint64(bits - 4)).astype(int), minlength=16).min() > n / 16 * 0.8


@pytest.mark.parametrize("width", [64, 128])
def test_filter_counts_exactly_and_merges(width):
    rng = np.random.default_rng(2)
    high = 1 << 32 if width == 64 else 1 << 62
    pool = rng.integers(0, high, (500, 2), np.uint64)
    pool[:20, 0], pool[20:40, 1] = 0, high - 1
    counts, shards = Counter(), []
    for _ in range(3):
        own = collocations.QuotientFilter(width)
        for _ in range(4):
            at = rng.zipf(1.3, 3000) % 500
            own.add(pool[at, 0], pool[at, 1])
            counts.update(map(tuple, pool[at].tolist()))
        shards += list(own.ranges(5))
    merged = collocations.QuotientFilter(width)
    for row in shards:
        merged.load(5, row)
    first, second, n = merged.frequent(1)
    assert Counter(dict(zip(zip(first.tolist(), second.tolist()), n.tolist()))) == counts
    first, second, n = merged.frequent(30)
    assert {k for k, c in counts.items() if c >= 30} == set(zip(first.tolist(), second.tolist()))
    assert list(collocations.QuotientFilter(width).ranges(5)) == []


def corpus(rng, n=150):
    vocabulary = [f"W{i}" for i in range(40)] + ["über", "日本"]
    stock = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 4, 6]))) for _ in range(12)]
    seps = [" ", " ", "  ", "\t", ". ", ",", "\n", " ; ", " "]
    texts, langs = [], []
    for _ in range(n):
        parts = [rng.choice(stock) if rng.random() < 0.7 else rng.choice(vocabulary) for _ in range(rng.choice([1, 8, 30]))]
        texts.append("".join(p + rng.choice(seps) for p in parts))
        langs.append(rng.choice(["en", "de", None, "und"]))
    texts += ["", None, " . ", "w1 " * 5000, texts[0], texts[0]]
    return texts, langs + ["en", "en", None, "en", langs[0], langs[0]]


@pytest.mark.parametrize("tier", [collocations.TIER, 10, 0])
def test_against_brute_force(docs_of, monkeypatch, tier):
    texts, langs = corpus(random.Random(7))
    monkeypatch.setattr(collocations, "WORDS_HELD", 50)
    monkeypatch.setattr(collocations, "KEYS_HELD", 300)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 2000)
    found = collocations.collocations(docs_of(texts, langs=langs).withColumnRenamed("kept", "score"), tier=tier)
    assert found.columns == COLUMNS and {t for c, t in found.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    expected = brute(zip(langs, texts))
    assert len(expected) > 30 and {r[0] for r in expected} == {"en", "de", "und"}
    assert rows_of(found) == expected


class Tier(dict):
    """Words that are looked up only."""

    def walked(self, *_):
        raise AssertionError("the tier is walked or copied")

    __iter__ = __or__ = __ror__ = keys = items = values = copy = walked


def test_a_text_costs_no_walk_over_the_tier(monkeypatch):
    """Words outside the tier come with their texts; one array for a chunk of
    texts, whether they have such words or not."""
    tier = {"en": Tier({b"one": 1, b"two": 2}), "de": Tier({b"one": 3})}
    assert sorted(collocations.outside(b"One three. four two three", tier["en"])) == [b"four", b"three"]
    rows = [
        ("en", "one three two", [{"word": b"three", "id": 9}]),
        ("en", "two four five", [{"word": b"four", "id": 8}]),
        ("de", "three one", [{"word": b"three", "id": 7}]),
        ("en", "two one", None),
    ]
    kind = pa.list_(pa.struct([("word", pa.binary()), ("id", pa.int64())]))
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), kind))]
    batch = pa.RecordBatch.from_arrays(columns, ["lang", "text", "more"])
    assert [a.tolist() for a in collocations.sequences(batch, tier)] == [[1, 9, 2, 0, 2, 8, 0, 0, 2, 1], [7, 3]]
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 1)
    assert [a.tolist() for a in collocations.sequences(batch, tier)] == [[1, 9, 2], [2, 8, 0], [7, 3], [2, 1]]


def test_top_and_ties(docs_of):
    rng = random.Random(3)
    texts, langs = corpus(rng, 80)
    # phrases of equal counts and scores, told apart by their bytes
    texts += [f"pair{i} tail{i}" for i in range(20) for _ in range(30)]
    langs += ["en"] * 600
    assert rows_of(collocations.collocations(docs_of(texts, langs=langs), top=7)) == brute(zip(langs, texts), top=7)


def test_empty_tables(docs_of):
    for texts in ([], ["", None], ["one two three"]):
        assert collocations.collocations(docs_of(texts)).count() == 0


def test_scores_past_64_bits(spark):
    """2000000 * a and the sums are exact decimals."""
    a = 9_000_000_000_000
    row = spark.range(1).selectExpr(
        f"CAST(2000000 AS DECIMAL(7, 0)) * CAST({a}L AS DECIMAL(19, 0)) div (CAST({a}L AS DECIMAL(19, 0)) + CAST({a + 1}L AS DECIMAL(19, 0))) s"
    ).first()
    assert row.s == 2_000_000 * a // (2 * a + 1)


def test_query_against_its_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    name = "op13_quotient_collocations"
    assert rows_of(QUERIES[name](spark, SF)) == sorted(con.execute(ORACLE[name]).fetchall())
