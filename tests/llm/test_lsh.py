"""Multiprobe hashing: recall, exact scores, ties, copies, odd vectors."""

import numpy as np

from playmart.llm import lsh, queries

from .conftest import SF


def brute(rows, k, every):
    """{query: [(vec_id, score)]} over (id, vector) rows, best first."""
    kept = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        kept.setdefault(i, set()).add(tuple(v))
    out = {}
    for q in (i for i in kept if i % every == 0):
        near = {}
        for y in kept[q]:
            for i, vectors in kept.items():
                for x in vectors:
                    if i != q and len(x) == len(y):
                        s = 0.0
                        for a, b in zip(y, x):
                            s += a * b
                        near[i] = max(near.get(i, -np.inf), s)
        out[q] = sorted(near.items(), key=lambda p: (-p[1], p[0]))[:k]
    return {q: v for q, v in out.items() if v}


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double").repartition(3)


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_odd_vectors_and_copies(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 4)).round(1)
    rows = [(i, base[i % 30].tolist()) for i in range(150)]
    rows += [(200 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(90)]  # a large group of copies
    rows += [(300, None), (301, [0.0, -0.0, 0.0, 0.0]), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan"), 1.0, 0.0, 0.0])]
    rows += [(304, [float("inf"), 1.0, 0.0, 0.0]), (320, [1.0, 2.0]), (321, [2.0, 2.0]), (340, [3.0]), (None, [1.0, 0.0, 0.0, 0.0])]
    rows += [(360, base[0].tolist()), (360, base[1].tolist()), (380, [9.0, 9.0, 9.0, 9.0]), (380, [9.0, 9.0, 9.0, 9.0]), (400, [-0.0, 1e-3, 0.0, 0.0])]
    rows += [(500 + i, (base[i] * 1e6).tolist()) for i in range(5)]
    got, expected = found(lsh.search(frame(spark, rows), k=8, every=20)), brute(rows, 8, 20)
    assert set(got) == set(expected)
    right = sum(len(set(dict(got[q])) & set(dict(expected[q]))) for q in expected)
    assert right >= 0.9 * sum(map(len, expected.values()))
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda p: (-p[1], p[0])) and q not in dict(hits)
        score = dict(brute(rows, 1000, 20)[q])
        assert all(score[i] == s for i, s in hits)


def test_all_rows_alike(spark):
    rows = [(i, [0.5, 0.25]) for i in range(100)]
    got = found(lsh.search(frame(spark, rows), k=20, every=20))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i in range(21) if i != q][:20] for q in range(0, 100, 20)}
    assert lsh.search(frame(spark, rows).limit(0)).count() == 0
    assert lsh.search(frame(spark, [(20, [1.0, 0.0])])).count() == 0


def test_crowded_buckets_are_split(spark, monkeypatch):
    """Blocks of crowded buckets give the same candidates."""
    rng = np.random.default_rng(2)
    x = np.r_[rng.standard_normal((300, 6)) * 0.01 + 1, rng.standard_normal((300, 6))]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    one = found(lsh.search(frame(spark, rows), k=10, every=20))
    monkeypatch.setattr(lsh, "BLOCK", 20)
    many = found(lsh.search(frame(spark, rows), k=10, every=20))
    assert one == many


def test_probe_order():
    rng = np.random.default_rng(3)
    hashing = lsh.projections(5, 1, 3)
    place = rng.random((4, 3))
    diff, cost = lsh.probe_order(place, 0, hashing, 200)
    assert (cost[:, 0] == 0).all() and (diff[:, 0] == 0).all() and (np.diff(cost, axis=1) >= 0).all()
    steps = np.arange(-2, 3)
    for i in range(4):
        c = [(np.where(steps > 0, steps - f, np.where(steps < 0, -steps - 1 + f, 0.0))) ** 2 for f in place[i]]
        every = np.sort((c[0][:, None, None] + c[1][None, :, None] + c[2][None, None, :]).ravel())
        assert np.allclose(cost[i], every[: cost.shape[1]])


def test_query_recall(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got, expected = found(queries.op1_multiprobe_lsh(spark, SF)), brute(rows, 20, 20)
    assert set(got) == set(expected) and all(len(v) == 20 for v in got.values())
    right = sum(len(set(dict(got[q])) & set(dict(expected[q]))) for q in expected)
    assert right >= 0.9 * 20 * len(expected)


def uneven(n, sigma):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((n, 32))
    return x / np.linalg.norm(x, axis=1)[:, None] * rng.lognormal(0, sigma, n)[:, None]


def recall(x, got, k):
    score = x[::20] @ x.T
    score[np.arange(len(score)), np.arange(0, len(x), 20)] = -np.inf
    top = np.argsort(-score, axis=1)[:, :k]
    return np.mean([len(set(t) & {i for i, _ in got.get(20 * j, [])}) / k for j, t in enumerate(top.tolist())])


def test_fit_counts_unreachable_neighbours(spark):
    """Uneven norms: what the fit calls reached is found."""
    for sigma in (0.5, 1.0):
        x = uneven(3_000, sigma)
        rows = [(i, v) for i, v in enumerate(x.tolist())]
        share = recall(x, found(lsh.search(frame(spark, rows), k=20, every=20)), 20)
        assert share >= 0.93, (sigma, share)


def test_exact_without_a_setting(spark, monkeypatch):
    monkeypatch.setattr(lsh, "WIDEN", [])
    x = uneven(600, 1.0)
    assert lsh.fit(x, len(x), float((x * x).sum(axis=1).max()), 20).exact
    monkeypatch.setattr(lsh, "BLOCK", 100)  # several blocks and groups
    monkeypatch.setattr(lsh, "GROUP", 64)
    assert recall(x, found(lsh.search(frame(spark, [(i, v) for i, v in enumerate(x.tolist())]), k=20, every=20)), 20) == 1.0
