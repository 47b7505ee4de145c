"""Nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Vectors are lengthened by one coordinate so
that all have the norm of the longest, which makes the largest inner product
the smallest Euclidean distance. A table hashes a vector to the cell numbers
of ``m`` Gaussian projections cut into cells of width W. A query visits, in
each table, its own bucket and perturbed ones in the order of their estimated
success: the sum of squared distances from the query to the cell borders that
are crossed. The candidates of all tables are ranked by their exact inner
products in double precision; what is below a query's k-th best score in the
sample is not sent on.

Cell width and projections follow the data: ``m`` grows with the logarithm
of the number of vectors, so buckets do not; the number of probes is fitted
on a bounded sample (``FIT_VECTORS``) to find ``FIT_RECALL`` of the true
neighbours there. Neighbours beyond the probed cells are not found; where that
leaves too few, there are fewer projections, then wider cells (``WIDEN``), and
where no setting reaches the recall all queries are compared with all vectors.
Queries are hashed with the last coordinate that true neighbours of the sample
have on average, so that uneven norms do not move all vectors out of reach.
Every vector is indexed.

Equal vectors are one entry of the index, which stands for its ``k + 1``
smallest ids: more can not be among anyone's k nearest. Buckets with more
than ``BLOCK`` different vectors are split over several tasks.

Vectors that are null, zero, or hold null or non-finite components take no
part. Vectors of different length are not compared. Repeated rows count once;
an id with several vectors is as near as the nearest of them. Extra columns
are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmart.llm.common import materialize

TABLES = 3
OCCUPANCY = 100
CELL = 2.0  # cell width in standard deviations of a projection
WIDEN = [1.0, 2.0, 4.0, 8.0]  # factors on it, tried in turn
REACH = 2  # cells a perturbation may move in one projection
FIT_VECTORS = 20_000
FIT_QUERIES = 200
FIT_RECALL = 0.95
MOST_PROBES = 1_024
BLOCK = 8_192
GROUP = 4_096  # indexed vectors of one group of buckets, on average
CHUNK = 512  # queries scored together

ROWS = "p long, dim int, kind int, h long, first long, floor double, bucket long, probes array<long>, vec array<double>"
FOUND = "q long, h long, first long, score double"


@dataclass
class Index:
    """Hash functions and fitted numbers; small and picklable."""

    tables: int
    m: int
    width: float
    norm2: float  # square of the largest norm
    probes: int
    groups: int
    blocks: dict  # bucket -> number of blocks, for buckets over BLOCK
    extra: float = 0.0  # last coordinate of queries
    exact: bool = False  # no setting reaches the recall


def projections(dim: int, tables: int, m: int):
    """Gaussian directions, shifts (in cells) and key multipliers."""
    import numpy as np

    rng = np.random.default_rng([7, dim])
    a = rng.standard_normal((tables, m, dim + 1))
    shift = rng.random((tables, m))
    keys = rng.integers(0, 1 << 64, (tables, m), dtype=np.uint64) | np.uint64(1)
    base = rng.integers(0, 1 << 64, tables, dtype=np.uint64)
    return a, shift, keys, base


def lengthened(x, norm2: float):
    """Vectors with the coordinate that evens out their norms."""
    import numpy as np

    return np.c_[x, np.sqrt(np.maximum(norm2 - (x * x).sum(axis=1), 0))]


def cells(index: Index, x, query: bool, table: int, hashing):
    """Cell numbers and places in the cells (0 to 1) of vectors."""
    import numpy as np

    a, shift, _, _ = hashing
    x = np.c_[x, np.full(len(x), index.extra)] if query else lengthened(x, index.norm2)
    y = x @ a[table].T / index.width + shift[table]
    c = np.floor(y)
    return c.astype(np.int64), y - c


def buckets(c, table: int, hashing):
    import numpy as np

    _, _, keys, base = hashing
    return (c.astype(np.uint64) * keys[table]).sum(axis=1, dtype=np.uint64) + base[table]


def probe_order(place, table: int, hashing, count: int):
    """(key differences, costs) of the ``count`` best perturbations of each
    query, in estimated success order; the first is none at all.

    Costs add up over projections, so keeping the best partial sums after
    each projection keeps the best totals.
    """
    import numpy as np

    n, m = place.shape
    keys = hashing[2][table]
    steps = np.arange(-REACH, REACH + 1)
    cost, diff = np.zeros((n, 1)), np.zeros((n, 1), np.uint64)
    for j in range(m):
        f = place[:, j, None]
        border = np.where(steps > 0, steps - f, np.where(steps < 0, -steps - 1 + f, 0.0))
        cost = (cost[:, :, None] + (border**2)[:, None, :]).reshape(n, -1)
        move = steps.astype(np.int64).astype(np.uint64) * keys[j]
        diff = (diff[:, :, None] + move[None, None, :]).reshape(n, -1)
        if cost.shape[1] > count:
            best = np.argpartition(cost, count - 1, axis=1)[:, :count]
            cost, diff = np.take_along_axis(cost, best, 1), np.take_along_axis(diff, best, 1)
    order = np.argsort(cost, axis=1, kind="stable")
    return np.take_along_axis(diff, order, 1), np.take_along_axis(cost, order, 1)


def fit(sample, count: int, norm2: float, k: int) -> Index:
    """Width, projections and probes from sample vectors of one length: the
    narrowest cells and the most projections (smallest buckets) that reach
    ``FIT_RECALL``."""
    import math

    import numpy as np

    x = np.asarray(sample, float)
    # cut into cells, a normal variable holds about ln(sqrt(2 pi e) / CELL) nats
    nats = math.log(math.sqrt(2 * math.pi * math.e) / CELL)
    most = max(2, min(24, round(math.log(max(count, 2) / OCCUPANCY) / nats)))
    asked = np.arange(0, len(x), max(1, len(x) // FIT_QUERIES))[:FIT_QUERIES]
    q = x[asked]
    score = q @ x.T
    score[np.arange(len(q)), asked] = -np.inf
    near = np.argsort(-score, axis=1)[:, : min(k, len(x) - 1)]
    extra = float(lengthened(x, norm2)[near.ravel(), -1].mean()) if near.size else 0.0
    index = Index(TABLES, 1, 1.0, norm2, 1, 1, {}, extra)
    for widen in WIDEN:
        for m in range(most, 0, -1):
            index = Index(TABLES, m, 1.0, norm2, 1, 1, {}, extra)
            hashing = projections(x.shape[1], TABLES, m)
            index.width = widen * CELL * float((lengthened(x, norm2) @ hashing[0][0].T).std(axis=0).mean() or 1.0)
            rank = np.full(near.shape, MOST_PROBES)  # probes until a table holds the neighbour
            for t in range(TABLES):
                cq, place = cells(index, q, True, t, hashing)
                cx, _ = cells(index, x, False, t, hashing)
                _, costs = probe_order(place, t, hashing, MOST_PROBES)
                step = cx[near] - cq[:, None, :]
                f = place[:, None, :]
                border = np.where(step > 0, step - f, np.where(step < 0, -step - 1 + f, 0.0))
                total = np.where((np.abs(step) <= REACH).all(axis=2), (border**2).sum(axis=2), np.inf)
                for i in range(len(q)):
                    at = np.searchsorted(costs[i], total[i] - 1e-9)
                    # beyond the reach no number of probes finds it
                    rank[i] = np.minimum(rank[i], np.where(np.isinf(total[i]), MOST_PROBES, at))
            found = np.sort(rank.ravel())
            last = int(found[math.ceil(FIT_RECALL * len(found)) - 1]) if len(found) else 0
            if last < MOST_PROBES:
                index.probes = last + 1
                return index
    # one table and one projection are enough to deal the vectors to groups
    index.tables, index.exact = 1, True
    return index


def group_of(bucket, block, groups: int):
    """The group of buckets (one unit of work) of a bucket's block."""
    import numpy as np

    x = bucket + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(block).astype(np.uint64) + np.uint64(1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(groups)).astype(np.int64)


def matrices(batch):
    """(dim, row numbers, matrix) of a batch's vectors, by their length."""
    import numpy as np

    vec = batch.column("vec")
    sizes = np.asarray(vec.value_lengths())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        values = vec.take(at).flatten().to_numpy(zero_copy_only=False)
        yield int(dim), at, values.reshape(len(at), int(dim))


def least_scores(queries, sample, k: int):
    """The k-th best inner product of each query in the sample: since the
    sample is part of the data, nothing below can be among its k nearest.
    Rounding leaves a little room."""
    import numpy as np

    if len(sample) < k or sample.shape[1] != queries.shape[1]:
        return np.full(len(queries), -np.inf)
    score = queries @ sample.T
    floor = np.partition(score, len(sample) - k, axis=1)[:, len(sample) - k]
    return floor - 1e-9 * (1 + np.abs(floor))


def hashed_rows(entries: DataFrame, index: Index, query: bool, sample=None, k: int = 0) -> DataFrame:
    """Index rows (one per table) or query rows (one per group visited). The
    sample, a broadcast matrix, gives queries the score that is worth finding."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        longs, doubles = pa.list_(pa.int64()), pa.list_(pa.float64())
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), longs, doubles]
        names = [c.split()[0] for c in ROWS.split(", ")]
        made: dict = {}
        for batch in batches:
            h, first = batch.column("h").to_numpy(), batch.column("first").to_numpy()
            for dim, at, x in matrices(batch):
                if dim not in made:
                    made[dim] = projections(dim, index.tables, index.m)
                hashing = made[dim]
                for a in range(0, len(x), CHUNK):
                    part, own = x[a : a + CHUNK], at[a : a + CHUNK]
                    floor = least_scores(part, sample.value, k) if query else np.zeros(len(part))
                    visits: list[tuple] = []  # (group, row, bucket)
                    for t in range(index.tables):
                        c, place = cells(index, part, query, t, hashing)
                        key = buckets(c, t, hashing)[:, None]
                        if query:
                            key = key + probe_order(place, t, hashing, index.probes)[0]
                        row = np.repeat(np.arange(len(part)), key.shape[1])
                        key = key.ravel()
                        if index.blocks:
                            many = np.array([index.blocks.get(int(b), 1) for b in key])
                            if query:
                                block = np.concatenate([np.arange(n) for n in many])
                                row, key = np.repeat(row, many), np.repeat(key, many)
                            else:
                                block = h[own[row]].astype(np.uint64) % many.astype(np.uint64)
                        else:
                            block = np.zeros(len(key), np.int64)
                        visits.append((group_of(key, block, index.groups), row, key))
                    p, row, key = (np.concatenate(v) for v in zip(*visits))
                    if query:  # one row for all buckets that a query visits in a group
                        order = np.lexsort((key, row, p))
                        p, row, key = p[order], row[order], key[order]
                        new = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (row[1:] != row[:-1])])
                        lists = [np.unique(s).view(np.int64) for s in np.split(key, new[1:])]
                        p, row = p[new], row[new]
                        bucket = [None] * len(p)
                    else:
                        lists, bucket = [None] * len(p), key.view(np.int64)
                    n = len(p)
                    same = [np.full(n, dim), np.full(n, int(query))]
                    values = [p, *same, h[own[row]], first[own[row]], floor[row], bucket, lists, list(part[row])]
                    yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(values, kinds)], names)

    return entries.mapInArrow(run, ROWS)


def scan(rows: DataFrame, k: int) -> DataFrame:
    """The k best entries of each query in each group, by exact inner product
    with the vectors in the buckets it visits there."""

    def best(q, h, first, score):
        import numpy as np

        order = np.lexsort((score, h, q))  # an entry may be found in several tables
        last = np.r_[(h[order][1:] != h[order][:-1]) | (q[order][1:] != q[order][:-1]), True]
        order = order[last]
        order = order[np.lexsort((first[order], -score[order], q[order]))]
        q, h, first, score = q[order], h[order], first[order], score[order]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)]))
        keep = rank < k
        return q[keep], h[keep], first[keep], score[keep]

    def match(members, queries):
        """Scores of one chunk of queries against the group's buckets."""
        import numpy as np

        bucket, h, first, x = members
        q, y, floor, probes, owner = queries
        names, starts = np.unique(bucket, return_index=True)
        ends = np.r_[starts[1:], len(bucket)]
        everywhere = np.setdiff1d(np.arange(len(q)), owner)  # queries that visit all buckets
        probes = np.r_[probes, np.tile(names, len(everywhere))]
        owner = np.r_[owner, np.repeat(everywhere, len(names))]
        at = np.searchsorted(names, probes)
        hit = (at < len(names)) & (names[np.minimum(at, len(names) - 1)] == probes)
        at, owner = at[hit], owner[hit]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else []
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(at)]):
            s, e = starts[at[a]], ends[at[a]]
            who = owner[a:b]
            score = y[who] @ x[s:e].T
            edge = floor[who]
            if e - s > k:
                # equal scores at the edge are settled by id: keep all that reach the k-th
                edge = np.maximum(edge, np.partition(score, e - s - k, axis=1)[:, e - s - k])
            i, j = np.nonzero(score >= edge[:, None])
            out.append((q[who[i]], h[s + j], first[s + j], score[i, j]))
        joined = [np.concatenate(v) for v in zip(*out)]
        return best(*joined) if joined and len(joined[0]) else None

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        group, held, members = None, [], None
        for batch in batches:
            p, dim, kind = (batch.column(c).to_numpy() for c in ("p", "dim", "kind"))
            change = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (dim[1:] != dim[:-1]) | (kind[1:] != kind[:-1])])
            for a, b in zip(change, [*change[1:], len(p)]):
                if group != (p[a], dim[a]):
                    group, held, members = (p[a], dim[a]), [], None
                part = batch.slice(a, b - a)
                x = part.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1)
                h, first, floor = (part.column(c).to_numpy() for c in ("h", "first", "floor"))
                if kind[a] == 0:
                    held.append((part.column("bucket").to_numpy(), h, first, x))
                    continue
                if members is None and held:
                    joined = [np.concatenate(v) for v in zip(*held)]
                    order = np.argsort(joined[0], kind="stable")
                    members, held = [v[order] for v in joined], []
                if members is None:
                    continue  # the query visits only empty buckets here
                lists = part.column("probes")
                sizes = np.asarray(lists.value_lengths())
                owner = np.repeat(np.arange(b - a), sizes)
                probes = lists.flatten().to_numpy()
                for s in range(0, b - a, CHUNK):
                    own = (owner >= s) & (owner < s + CHUNK)
                    e = s + CHUNK
                    got = match(members, (h[s:e], x[s:e], floor[s:e], probes[own], owner[own] - s))
                    if got is not None:
                        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(got, kinds)], ["q", "h", "first", "score"])

    return rows.repartition("p").sortWithinPartitions("p", "dim", "kind").mapInArrow(run, FOUND)


def everywhere_rows(entries: DataFrame, groups: int) -> DataFrame:
    """Query rows that visit every bucket of every group."""
    return entries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("p"),
        F.size("vec").alias("dim"),
        F.lit(1).alias("kind"),
        "h",
        "first",
        F.lit(float("-inf")).alias("floor"),
        F.lit(None).cast("long").alias("bucket"),
        F.expr("cast(array() AS array<bigint>)").alias("probes"),
        "vec",
    )


def valid_vectors(table: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(vec_id, vec, h) of the vectors that take part; -0.0 becomes 0.0."""
    vec = F.transform(F.col(vector).cast("array<double>"), lambda x: x + F.lit(0.0))
    out = table.select(F.col(id_column).cast("long").alias("vec_id"), vec.alias("vec")).where(
        "vec_id is not null and vec is not null and exists(vec, x -> x <> 0) "
        "and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    return out.withColumn("h", F.xxhash64("vec"))


def search(table: DataFrame, k: int = 20, every: int = 20, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose
    id is divisible by ``every``, nearest first, ties to the smaller id."""
    import numpy as np

    vectors = valid_vectors(table, id_column, vector)
    # the k + 1 smallest ids of each different vector; ranked before the shuffle too
    ids = Window.partitionBy("h", "vec").orderBy("vec_id")
    ranked = vectors.withColumn("r", F.dense_rank().over(ids)).where(F.col("r") <= k + 1).distinct()
    ranked = materialize(ranked, "vectors")
    entries = ranked.where("r = 1").select("h", F.col("vec_id").alias("first"), "vec")
    sizes = entries.agg(
        F.count("*").alias("n"), F.max(F.expr("aggregate(vec, 0D, (a, x) -> a + x * x)")).alias("norm2"), F.expr("mode(size(vec))").alias("dim")
    ).first()
    if not sizes.n:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = entries.where(F.size("vec") == sizes.dim).sample(min(1.0, FIT_VECTORS / sizes.n), seed=11).select("vec").collect()
    sample = sorted(r.vec for r in sample) or [r.vec for r in entries.where(F.size("vec") == sizes.dim).limit(1).collect()]
    index = fit(np.array(sample), sizes.n, sizes.norm2, k)
    index.groups = max(1, -(-sizes.n * index.tables // GROUP))
    # at most tables * n / block buckets can be over a block; their list stays below 50,000
    block = max(BLOCK, sizes.n * index.tables // 50_000)
    placed = hashed_rows(entries, index, False)
    crowded = placed.groupBy("bucket").agg(F.count("*").alias("c")).where(F.col("c") > block).collect()
    index.blocks = {r.bucket % (1 << 64): -(-r.c // block) for r in crowded}
    index.groups += sum(index.blocks.values())

    asked = vectors.where(F.pmod("vec_id", F.lit(every)) == 0).select("h", "vec_id").distinct()
    asked = materialize(asked, "queries")
    query_entries = entries.join(asked.select("h").distinct(), "h", "left_semi")
    top = Window.partitionBy("q").orderBy(F.desc("near"), "first")

    def nearest(rows: DataFrame, name: str) -> DataFrame:
        found = scan(hashed_rows(entries, index, False).unionByName(rows), k + 1)
        found = found.groupBy("q", "h").agg(F.max("first").alias("first"), F.max("score").alias("near"))
        found = found.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1)
        return materialize(found.select("q", "h"), name)

    # a quarter of the data at most, or the floor alone would settle the answer
    some = sample[:: max(1, -(-4 * len(sample) // sizes.n))]
    shared = table.sparkSession.sparkContext.broadcast(np.array(some))
    if index.exact:
        asking = everywhere_rows(query_entries.select("h", "first", "vec"), index.groups)
    else:
        asking = hashed_rows(query_entries, index, True, shared, k + 1)
    found = nearest(asking, "found")
    # queries whose buckets hold too few entries are compared with all
    there = entries.groupBy(F.size("vec").alias("dim")).agg(F.least(F.count("*"), F.lit(k + 1)).alias("wanted"))
    have = found.groupBy("q").agg(F.count("*").alias("have"))
    short = (
        query_entries.join(have, F.col("h") == F.col("q"), "left")
        .join(there, F.size("vec") == F.col("dim"))
        .where(F.coalesce("have", F.lit(0)) < F.col("wanted"))
        .select("h", "first", "vec")
    )
    short = materialize(short, "short-queries")
    if short.limit(1).count():
        rest = nearest(everywhere_rows(short, index.groups), "found-everywhere")
        found = found.join(short.select(F.col("h").alias("q")), "q", "left_anti").unionByName(rest)
    # the reported score: products summed in order
    vec_of = entries.select("h", "vec")
    found = found.join(vec_of, "h").join(vec_of.toDF("q", "q_vec"), "q")
    score = F.expr("aggregate(zip_with(q_vec, vec, (a, b) -> a * b), 0D, (s, x) -> s + x)")
    found = found.select("q", "h", score.alias("score"))
    hits = (
        found.join(ranked.select("h", "vec_id"), "h")
        .join(asked.select(F.col("h").alias("q"), F.col("vec_id").alias("query_id")), "q")
        .where("vec_id <> query_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
