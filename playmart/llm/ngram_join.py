"""N-gram Jaccard join by PartEnum signatures.

A document's set is its distinct word n-grams (ASCII letters lower-cased,
words split at ASCII white space; a shorter text is one n-gram). Set sizes
are cut into bands, each at most ``den / num`` wide, so that linked sets lie
in one band or in neighbours, and every set signs for its band and the next.
In a band two linked sets differ in at most k elements. The element domain is
hashed into n1 first-level partitions, of which one holds at most one
differing element, and each of these into n2 second-level partitions; each
subset of n2 - 1 of them gives a signature, the hash of the set's elements
in it. Two linked sets therefore always share a signature.

Sets that share signatures form candidate components; ``setlinks`` finds the
exact links in them and ``components`` the classes. Equal sets (128-bit keys)
form one class before any comparison, and of many sets of a batch with one
signature only one sends it on, with an edge to it from the others, so a large
group of copies costs its members once.

Null text and texts without words have an empty set and are linked with
nothing. Rows with one doc_id belong together; rows without a doc_id are
returned without a component. Extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm import common, components, setlinks, vocab

SIGNED = "doc_id long, n_shingles long, key1 long, key2 long, signatures array<long>, near array<long>"
MEMBERS = "key1 long, elements array<long>"
SECOND_LEVEL = 3
# With this many first-level partitions, subsets without elements do not sign:
# they would join all sets of a band, while two linked sets agree in several
# partitions and have elements in some of them (but for about one pair in 10^7).
EMPTY_SIGNS_BELOW = 8


def mixed(x, seed: int):
    """64-bit finalizer of a numpy array, different for every seed."""
    import numpy as np

    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def band_ends(num: int, den: int, size: int) -> tuple[int, list[int]]:
    """The band of a set size, and the largest size of each band up to the next."""
    ends, low = [], 1
    while len(ends) < 2 or ends[-2] < size:
        ends.append(low * den // num)
        low = ends[-1] + 1
    return len(ends) - 2, ends


class Shingler:
    """Hashes of word n-grams; words go through a bounded cache."""

    def __init__(self):
        self.words = vocab.Cache()

    def word(self, w: bytes) -> int:
        import xxhash

        h = self.words.get(w)
        return self.words.put(w, xxhash.xxh64_intdigest(w)) if h is None else h

    def elements(self, text: str, size: int):
        """Sorted distinct 64-bit hashes of the text's n-grams."""
        import numpy as np

        words = text.encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        found = list(map(self.words.new.get, words))
        if None in found:
            found = [self.word(w) if h is None else h for w, h in zip(words, found)]
        h = np.array(found, np.uint64)
        span = min(size, len(h))
        out = np.full(len(h) - span + 1, span, np.uint64)
        for i in range(span):
            out = mixed(out ^ h[i : len(h) - span + 1 + i], i)
        return np.unique(out)


def signatures(elements, num: int, den: int):
    """PartEnum signatures of one set of element hashes."""
    import numpy as np

    out = []
    own, ends = band_ends(num, den, len(elements))
    value = mixed(elements, 1)
    low, high = (value & np.uint64(0xFFFFFFFF)).astype(float), (value >> np.uint64(32)).astype(float)
    for band in (own, own + 1):
        k = 2 * ends[band] * (den - num) // (den + num)
        if k == 0:
            continue  # only equal sets are linked here, and equal sets share a key
        n1, n2 = -(-(k + 1) // 2), SECOND_LEVEL
        place = mixed(elements, 1_000 + band)
        cell = ((place >> np.uint64(32)) % np.uint64(n1) * np.uint64(n2) + (place & np.uint64(0xFFFFFFFF)) % np.uint64(n2)).astype(
            np.int64
        )
        # sums of the hashes in each cell, modulo 2^64, from exact half sums
        sums = np.bincount(cell, low, n1 * n2).astype(np.uint64) + (
            np.bincount(cell, high, n1 * n2).astype(np.uint64) << np.uint64(32)
        )
        sums = sums.reshape(n1, n2)
        subset = sums.sum(axis=1, dtype=np.uint64)[:, None] - sums  # all second-level cells but one
        tag = mixed(np.arange(n1 * n2, dtype=np.uint64), 5_000 + band).reshape(n1, n2)
        sign = mixed(subset ^ tag, 2).ravel()
        out.append(sign if n1 < EMPTY_SIGNS_BELOW else sign[subset.ravel() != 0])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def signed(docs: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Set size, set key and signatures of every document."""

    def sign(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        shingler = common.worker_state("shingler", Shingler)
        for batch in batches:
            ids, found = batch.column("doc_id").to_pylist(), common.texts(batch.column("text"))
            rows, first_of, signs = [], {}, []
            for row, text in enumerate(found):
                e = shingler.elements(text, size)
                keys = (set_key(e, 3), set_key(e, 4))
                rows.append((len(e), *keys))
                # of equal sets in a batch the first one signs for all
                new = len(e) and ids[row] is not None and first_of.setdefault((len(e), *keys), row) == row
                signs.append(signatures(e, num, den) if new else np.empty(0, np.uint64))
            # of different sets with one signature the first one sends it on
            everything = np.concatenate(signs) if signs else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(signs)), [len(s) for s in signs])
            _, first, inverse = np.unique(everything, return_index=True, return_inverse=True)
            leader = owner[first][inverse] if len(everything) else owner
            kept: list = [[] for _ in ids]
            near: list = [[] for _ in ids]
            is_first = np.zeros(len(everything), bool)
            is_first[first] = True
            at = 0
            for row, own in enumerate(signs):
                span = slice(at, at + len(own))
                kept[row] = own[is_first[span]].view(np.int64)
                near[row] = [ids[i] for i in np.unique(leader[span]) if ids[i] != ids[row]]
                at += len(own)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array(kept, longs),
                    pa.array(near, longs),
                ],
                [c.split()[0] for c in SIGNED.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, SIGNED)


def set_key(elements, seed: int) -> int:
    """64-bit key of a set; two seeds make the 128-bit key."""
    import numpy as np

    return int(mixed(elements, seed).sum(dtype=np.uint64).astype(np.int64))


def element_sets(docs: DataFrame, size: int) -> DataFrame:
    """(key1, elements) of the documents' sets, as signed hashes."""

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        shingler = common.worker_state("shingler", Shingler)
        for batch in batches:
            found = common.texts(batch.column("text"))
            for a in range(0, len(found), 500):  # sets are larger than their texts
                sets = [shingler.elements(t, size) for t in found[a : a + 500]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_key(e, 3) for e in sets], pa.int64()),
                        pa.array([e.view(np.int64) for e in sets], pa.list_(pa.int64())),
                    ],
                    ["key1", "elements"],
                )

    return docs.select("text").mapInArrow(build, MEMBERS)


def classes(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document row: the
    smallest doc_id reachable by links of Jaccard similarity >= num / den."""
    base = common.materialize(signed(docs, size, num, den), "signatures")
    sets = base.where("n_shingles > 0 and doc_id is not null").select("doc_id", "n_shingles", "key1", "key2")
    key = ["n_shingles", "key1", "key2"]
    heads = sets.groupBy(*key).agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).where("head < last")
    equal = common.materialize(
        sets.join(heads, key).where("doc_id <> head").select("doc_id", "head").distinct(), "equal-sets"
    )

    # a star per signature around its smallest document
    shared = components.stars(base.select("doc_id", F.explode("signatures").alias("s")), "s", "doc_id")
    near = base.select("doc_id", F.explode("near").alias("head"))
    rooted = components.components(shared.unionByName(near).unionByName(equal).distinct())
    grouped = rooted.unionByName(rooted.select(F.col("root").alias("node"), "root").distinct())
    # the different sets of each candidate component, each with its smallest document
    reps = (
        sets.join(grouped, F.col("doc_id") == F.col("node"))
        .groupBy("key1")
        .agg(F.min("doc_id").alias("rep"), F.min("root").alias("comp"))
    )
    reps = common.materialize(reps, "candidates")
    several = reps.groupBy("comp").agg(F.count("*").alias("c")).where("c > 1").select(F.col("comp").alias("several"))
    reps = reps.join(several, F.col("comp") == F.col("several"), "left_semi")
    wanted = reps.select("rep").distinct()
    texts = common.likely(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", wanted, "rep")
    found = element_sets(texts.join(wanted, texts["doc_id"] == wanted["rep"], "left_semi"), size)
    members = found.join(reps, "key1").select("comp", F.col("key1").alias("id"), "elements").dropDuplicates(["id"])
    linked = setlinks.links(common.materialize(members, "members"), num, den)
    ids = reps.select("key1", "rep")
    edges = (
        linked.join(ids.toDF("a", "doc_a"), "a").join(ids.toDF("b", "doc_b"), "b").select("doc_a", "doc_b")
    ).unionByName(equal.toDF("doc_a", "doc_b"))
    roots = components.components(edges)
    return base.join(roots, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")
    )
