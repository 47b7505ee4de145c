"""Statistics against a plain count; verdicts against a numpy estimate."""

import re
from collections import Counter

import numpy as np

from playmart.llm import quality, queries
from playmart.llm.common import table

from .conftest import SF

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if seen[w] > 1 for j in range(5)}
    chars = sum(map(len, words))
    return (len(words), chars, sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


ODD = [
    "", None, " \t\n", "a b c d e a b c d e", "x x x x x x x x", "a\nb\na\n\n \nb", "é😀 \x1c #*$%&|<> \x00 z q", "w " * 30_000,
    "\r\n".join(["line one here"] * 4), "one two three four five six seven eight nine ten", "same", "same", "z" * 50_000,
    " ".join(str(i % 97) for i in range(5000)),
]


def test_counts(docs_of):
    got = {r.doc_id: r for r in quality.judge(docs_of(ODD)).collect()}
    assert len(got) == len(ODD)
    for i, t in enumerate(ODD):
        c = brute_counts(t)
        assert tuple(got[i][n] for n in quality.COUNTS) == c, (i, t and t[:30])
        assert got[i].base_failed == (c[0] < 10 or 100 * c[4] > 20 * c[0])
        assert got[i].kept == (not got[i].base_failed)  # too few rows for an estimate
    assert quality.judge(docs_of([])).count() == 0
    kept = quality.keep(docs_of(ODD))
    assert kept.columns == docs_of(ODD).columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}


def corpus(rng, n):
    texts = []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 9))) for _ in range(int(rng.integers(30, 400)))]
        if i % 25 == 0:
            words = [w + "###$$$" for w in words]
        if i % 25 == 1:
            words = [w * 12 for w in words]
        texts.append(" ".join(words))
    return texts


def brute_kept(rows):
    """Verdicts of one group: concentration steps in numpy."""
    c = np.array([brute_counts(t) for t in rows], float)
    failed = (c[:, 0] < 10) | (100 * c[:, 4] > 20 * c[:, 0])
    n = np.maximum(c[:, 0], 1)
    x = np.c_[
        np.log(1 + c[:, 0]), np.log(1 + c[:, 1] / n), np.log(1 + 1000 * c[:, 2] / np.maximum(c[:, 1], 1)),
        np.log(1 + 100 * c[:, 3] / n), np.log(1 + 100 * c[:, 4] / n),
    ]
    x = np.floor(x * quality.GRID + 0.5) / quality.GRID
    good = x[~failed]
    floor = np.diag([f * f for _, f in quality.STATISTICS.values()])
    centre = np.median(good, axis=0)
    spread = np.median(np.abs(good - centre), axis=0) * 1.4826
    cov = np.diag(spread**2) + floor

    def distance(z, m, s):
        return np.einsum("ij,jk,ik->i", z - m, np.linalg.inv(s), z - m)

    m = centre
    for _ in range(quality.STEPS):
        q = np.floor(quality.GRID * np.log(1 + distance(good, m, cov)))
        core = good[q <= np.quantile(q, quality.CORE)]
        m = core.mean(axis=0)
        cov = quality.CONSISTENCY * np.cov(core.T, bias=True) + floor
    return ~failed & (distance(x, m, cov) <= quality.CUTOFF), distance(x, m, cov)


def test_outliers(docs_of):
    rng = np.random.default_rng(4)
    a, b = corpus(rng, 200), corpus(rng, 120)
    docs = docs_of(a + b, langs=["en"] * 200 + [None] * 120, sources=["s"] * 200 + ["t"] * 120, parts=4)
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    verdicts = np.r_[brute_kept(a)[0], brute_kept(b)[0]]
    distances = np.r_[brute_kept(a)[1], brute_kept(b)[1]]
    assert [got[i].kept for i in range(320)] == verdicts.tolist()
    assert np.allclose([got[i].d2 for i in range(320) if got[i].d2 is not None], [d for i, d in enumerate(distances) if got[i].d2 is not None])
    assert not verdicts[0:200:25].any() and verdicts[2:200:25].all()
    assert {r.doc_id for r in quality.keep(docs).collect()} == set(np.flatnonzero(verdicts).tolist())


def test_query(spark):
    rows = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = queries.op5_robust_outliers(spark, SF)
    assert got.columns == ["doc_id", *quality.COUNTS, "base_failed", "kept"]
    for r in got.collect():
        assert tuple(r[n] for n in quality.COUNTS) == brute_counts(rows[r.doc_id])


def test_small_groups_are_judged(docs_of):
    """A long tail of sources is judged by its language, a rare language by all."""
    rng = np.random.default_rng(8)
    texts = corpus(rng, 260)
    langs = ["en"] * 200 + ["de"] * 40 + [None] * 20
    sources = ["big"] * 120 + [f"s{i}" for i in range(80)] + ["t"] * 60
    got = {r.doc_id: r for r in quality.judge(docs_of(texts, langs=langs, sources=sources)).collect()}
    own, lang, all_docs = (brute_kept(texts[:n]) for n in (120, 200, 260))
    verdicts = np.r_[own[0], lang[0][120:], all_docs[0][200:]]
    distances = np.r_[own[1], lang[1][120:], all_docs[1][200:]]
    assert [got[i].kept for i in range(260)] == verdicts.tolist()
    assert np.allclose([got[i].d2 for i in range(260)], distances)
    assert not verdicts[125::25].any() and not verdicts[126::25].any()
    kept = quality.keep(docs_of(texts, langs=langs, sources=sources))
    assert {r.doc_id for r in kept.collect()} == set(np.flatnonzero(verdicts).tolist())
