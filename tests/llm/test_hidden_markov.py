import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import hidden_markov as hm
from playmart.llm.common import table
from playmart.llm.queries import QUERIES

from .conftest import SF

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER)) + [None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def brute_base(ids, texts):
    c = Counter(w for i, t in zip(ids, texts) if not held(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    rows = []
    for i, t in zip(ids, texts):
        w = split(t)
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        rows.append((i, held(i), len(w), sum(c[x] > 0 for x in w), n, base))
    return rows


def emissions(model):
    """word -> probability in each state, from the vocabulary table."""
    rows = model.vocabulary.collect()
    states = len(model.start)
    shares = hm.unpacked([r.p0 for r in rows], [r.p1 for r in rows], states)
    assert (shares.sum(axis=1) == hm.SHARES).all()
    scorer = hm.Scorer(model.start, model.moves, model.share, model.n, model.v)
    emit = scorer.emission(np.array([r.f for r in rows]), [r.p0 for r in rows], [r.p1 for r in rows])
    return {bytes(r.word): e for r, e in zip(rows, emit)}, scorer.emission(np.zeros(1), [0], [0])[0]


def brute_score(model, text):
    """Log of the sum over all state sequences, by the plain recursion."""
    emit, unknown = emissions(model)
    total, log = np.asarray(model.start, float), 0.0
    for i, w in enumerate(split(text)):
        if i:
            total = total @ model.moves
        total = total * emit.get(b"" if w is None else w.encode(), unknown)
        log += math.log10(total.sum())
        total = total / total.sum()
    return log


def test_words_are_the_matches():
    import pyarrow as pa

    texts = ["A b \x1cC\x0bd\x85e É\tZ\r\n", "", " \n", None, "x", " x", "x ", "  x  y  ", "ÀA"]
    words, counts = hm.words_of(pa.array(texts, pa.string()))
    expected = [split(t) for t in texts]
    assert list(counts) == [len(w) for w in expected]
    assert [w.decode() or None for w in words.to_pylist()] == [w for x in expected for w in x]
    sliced, counts = hm.words_of(pa.array(texts, pa.string()).slice(4, 3))
    assert sliced.to_pylist() == [b"x", b""] * 3 and list(counts) == [2, 2, 2]
    none, counts = hm.words_of(pa.array([], pa.string()))
    assert len(none) == len(counts) == 0


def test_recursions_against_enumeration():
    rng = np.random.default_rng(1)
    k, lengths = 3, np.array([5, 3, 3, 1])
    start, moves = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k)
    each = [rng.random((n, k)) for n in lengths]
    layout = hm.Layout(lengths)
    emitted = np.concatenate(each)[layout.order]
    gamma, first, pairs = hm.expected(layout, emitted.copy(), start, moves)
    _, scale = hm.forward(layout, emitted, start, moves)
    total_first, total_pairs = np.zeros(k), np.zeros((k, k))
    for t, e in enumerate(each):
        weights = {}
        for path in np.ndindex(*[k] * len(e)):
            p = start[path[0]] * e[0, path[0]]
            for i in range(1, len(e)):
                p *= moves[path[i - 1], path[i]] * e[i, path[i]]
            weights[path] = p
        likelihood = sum(weights.values())
        assert np.isclose(np.log(scale)[layout.text == t].sum(), math.log(likelihood))
        expected = np.zeros((len(e), k))
        for path, p in weights.items():
            total_first[path[0]] += p / likelihood
            for i, s in enumerate(path):
                expected[i, s] += p / likelihood
                if i:
                    total_pairs[path[i - 1], s] += p / likelihood
        assert np.allclose(gamma[layout.text == t], expected)
    assert np.allclose(first, total_first) and np.allclose(pairs, total_pairs)


def test_forward_in_place():
    """Scoring keeps one table of the tokens; scales are the same to the bit."""
    rng = np.random.default_rng(2)
    lengths = np.array([9, 4, 4, 1])
    start, moves = rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3)
    layout, emitted = hm.Layout(lengths), rng.random((18, 3))
    alpha, scale = hm.forward(layout, emitted, start, moves)
    placed, again = hm.forward(layout, emitted, start, moves, out=emitted)
    assert placed is emitted and (placed == alpha).all() and (again == scale).all()


def corpus(rng, n=200):
    """Two kinds of texts with words of their own, and rare words."""
    kinds = [[f"A{i}" for i in range(30)], [f"b{i}é" for i in range(30)]]
    texts = []
    for _ in range(n):
        own = rng.choice(kinds)
        texts.append(" ".join(rng.choice(own) if rng.random() < 0.95 else f"rare{rng.randrange(200)}" for _ in range(rng.choice([1, 12, 60]))))
    return texts + ["", None, " \n\t", "a1 " * 5000, texts[0], texts[0]]


@pytest.mark.parametrize("tier", [hm.TIER, 20, 0])
def test_scores_against_plain_recursion(docs_of, monkeypatch, tier):
    monkeypatch.setattr(hm, "WORDS_HELD", 40)
    monkeypatch.setattr(hm, "CHUNK_TOKENS", 500)
    texts = corpus(random.Random(5))
    ids = list(range(len(texts)))
    ids[7] = None
    ids[-1] = ids[-2]  # a row repeated exactly
    docs = docs_of(texts, ids=ids).withColumnRenamed("kept", "score")
    model = hm.fit(docs, states=3, tier=tier)
    got = sorted(map(tuple, hm.score(docs, model).collect()), key=lambda r: repr(r[:5]))
    expected = sorted(brute_base(ids, texts), key=lambda r: repr(r[:5]))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose(sorted(r[5] for r in got), sorted(r[5] for r in expected), rtol=1e-12)
    wanted = sorted(brute_score(model, t) for t in texts[:40] + texts[-6:])
    some = {i for i in ids[:40] + ids[-6:]}
    assert np.allclose(sorted(r[6] for r in got if r[0] in some), wanted, rtol=1e-9)
    # words and the unknown one: probabilities of a state sum to 1
    emit, unknown = emissions(model)
    assert np.allclose(sum(emit.values()) + unknown, 1)
    assert np.allclose(model.moves.sum(axis=1), 1) and math.isclose(model.start.sum(), 1)
    assert model.v == len(emit) == len({w for i, t in zip(ids, texts) if not held(i) for w in split(t)})


def test_states_tell_kinds_of_text_apart(docs_of):
    texts = corpus(random.Random(6), 400)
    docs = docs_of(texts)
    rows = hm.score(docs, hm.fit(docs, states=4)).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    assert gain > 0.15  # half the words at most: log10(2) is 0.30


def test_fit_does_not_depend_on_the_order_of_rows(docs_of):
    texts = corpus(random.Random(8), 60)
    one, two = (hm.score(d, hm.fit(d, states=2)).collect() for d in (docs_of(texts, parts=1), docs_of(texts, parts=1)))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_every_step_sees_all_training_texts(docs_of, monkeypatch):
    seen, plain = [], hm.expectations

    def watched(*args):
        sums = plain(*args)
        seen.append(sums.where("symbol >= 0").agg(F.sum("n")).first()[0])
        return sums

    monkeypatch.setattr(hm, "expectations", watched)
    texts = [f"a{i % 7} b{i % 11} rare{i}" for i in range(3_000)]
    model = hm.fit(docs_of(texts), states=2, tier=20, steps=3)
    assert model.n == 4 * sum(not held(i) for i in range(3_000))
    assert seen == [model.n] * 3


def test_empty_tables(docs_of):
    empty = docs_of([])
    assert hm.score(empty, hm.fit(empty)).count() == 0
    held_only = docs_of(["a b", None], ids=[i for i in range(50) if held(i)][:2])
    rows = hm.score(held_only, hm.fit(held_only)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows) == [(1, 0, 0, 0, 0), (3, 0, 0, 0, 0)]


def test_query_on_documents(spark):
    rows = QUERIES["op11_hidden_markov"](spark, SF).collect()
    docs = table(spark, SF, "documents").collect()
    base = {r[0]: r for r in brute_base([d.doc_id for d in docs], [d.text for d in docs])}
    assert len(rows) == len(docs)
    for r in rows:
        assert tuple(r)[:5] == base[r.doc_id][:5] and math.isclose(r.base_score, base[r.doc_id][5], rel_tol=1e-9)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
