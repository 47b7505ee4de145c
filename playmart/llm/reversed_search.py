"""Ranked lexical search, reversed: the items are indexed, documents stream.

The terms of a block of items form an inverted index (term -> items) that is
broadcast; every task streams the term counts of its documents through it and
keeps a heap of the ``k`` best documents per item. The heaps, ``k`` entries
per item and task at most, are merged by rank. Documents are never shuffled.

A block holds about ``BLOCK_BYTES`` of item texts, which bounds the broadcast
and the heaps; more items are more blocks, each with two passes over the
documents (document frequencies, then scores).

Terms are maximal runs of ASCII letters and digits and of all other
characters outside ASCII, with A-Z lower-cased. With N documents holding a
term, L their terms in all, df documents with the term, tf occurrences in a
document of n terms, ``w = floor(1000 ln((2N+2)/(2df+1)))``, ``m = 100 - 90 +
(90 n N) div L``, the score sums ``w * (10^9 tf div (1000 tf + 8 m))`` over
an item's terms, once each, in exact integers.

A document without terms (null, empty, only ASCII signs) scores nothing and
does not count. Rows repeated exactly are documents of their own with equal
scores; equal scores rank by doc_id, those without one last. Item rows of
one id are one item with all their terms; an item without terms, and a corpus
without documents, give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat
from math import floor, log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K = 10
# Text of the items of one block, about; hashing spreads items over blocks.
BLOCK_BYTES = 32 << 20
# Scores held at once in a task: documents x items of a chunk.
CELLS = 1 << 21
# Terms of the documents taken together.
CHUNK_TERMS = 1 << 19

FOUND = "item_id long, doc_id long, score long"
_N, _L = -1, -2  # keys of the corpus totals among the document frequencies

# Bytes of terms map to themselves or their lower case, all others to a space.
TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def terms(data: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order, with repeats."""
    return data.translate(TERM_BYTES).split()


def raw(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null is the empty text."""
    import pyarrow as pa

    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


@dataclass
class Index:
    """Inverted index of a block of items: the items of term t are
    ``postings[starts[t]:starts[t + 1]]``."""

    item_ids: list
    term_ids: dict[bytes, int]
    starts: object
    postings: object

    @classmethod
    def build(cls, rows) -> Index:
        import numpy as np

        of_item: dict = {}
        for item_id, text in rows:
            of_item.setdefault(item_id, set()).update(terms((text or "").encode("utf-8", "replace")))
        items = sorted(of_item, key=lambda i: (i is None, i or 0))
        of_term: dict[bytes, list[int]] = {}
        for i, item in enumerate(items):
            for t in sorted(of_item[item]):
                of_term.setdefault(t, []).append(i)
        sizes = [len(p) for p in of_term.values()]
        return cls(
            items,
            {t: j for j, t in enumerate(of_term)},
            np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int64),
            np.array([i for p in of_term.values() for i in p], np.int64),
        )


def blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items, split by hash of their id into blocks of about so many bytes."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    place = F.pmod(F.xxhash64(F.coalesce("item_id", F.lit(-1).cast("long"))), F.lit(n))
    return [rows.where(place == b) if n > 1 else rows for b in range(n)]


def frequencies(docs: DataFrame, shared) -> tuple[int, int, dict[int, int]]:
    """N, L and the document frequency of each term of the index."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        ids = shared.value[1]
        found: Counter[int] = Counter()
        for batch in batches:
            for data in raw(batch.column("text")):
                words = terms(data)
                if words:
                    found[_N] += 1
                    found[_L] += len(words)
                    found.update(map(ids.__getitem__, ids.keys() & set(words)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["term", "n"]
        )

    sums = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r.term: r.n for r in sums.collect()}  # as many rows as the block has terms
    return found.pop(_N, 0), found.pop(_L, 0), found


class Heaps:
    """The best documents of every item of an index, in this task."""

    def __init__(self, index: Index, n: int, length: int, df: dict[int, int], k: int):
        import numpy as np

        self.index, self.n, self.length, self.k = index, n, length, k
        self.weights = np.array(
            [floor(1000 * log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(index.term_ids))], np.int64
        )
        self.heaps: list[list] = [[] for _ in index.item_ids]
        self.least = np.ones(len(index.item_ids), np.int64)  # a score below it cannot enter

    def add(self, doc_ids: list, words: list[list[bytes]]) -> None:
        """Scores a chunk of documents and updates the heaps."""
        import numpy as np

        index = self.index
        lookup = index.term_ids.get
        at = [np.fromiter(map(lookup, w, repeat(-1)), np.int64, len(w)) for w in words]
        doc = np.repeat(np.arange(len(words)), [len(w) for w in words])
        term = np.concatenate(at)
        known = term >= 0
        size = len(index.term_ids)
        pairs, tf = np.unique(doc[known] * size + term[known], return_counts=True)
        doc, term = pairs // size, pairs % size
        m = np.array([10 + (90 * len(w) * self.n) // self.length for w in words], np.int64)
        part = self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
        # every (document, term) meets the items of the term
        many = index.starts[term + 1] - index.starts[term]
        first = np.repeat(index.starts[term] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
        item = index.postings[first + np.arange(len(first))]
        scores = np.zeros((len(words), len(index.item_ids)), np.int64)
        np.add.at(scores, (np.repeat(doc, many), item), np.repeat(part, many))
        for d, i in zip(*np.nonzero(scores >= self.least)):
            self.push(i, int(scores[d, i]), doc_ids[d])

    def push(self, item: int, score: int, doc_id) -> None:
        heap = self.heaps[item]
        entry = (score, -(1 << 63) if doc_id is None else -doc_id)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.least[item] = heap[0][0]

    def rows(self) -> list[tuple]:
        return [
            (item, None if key == -(1 << 63) else -key, score)
            for item, heap in zip(self.index.item_ids, self.heaps)
            for score, key in heap
        ]


def best_of_tasks(docs: DataFrame, shared, n: int, length: int, df: dict[int, int], k: int) -> DataFrame:
    """(item_id, doc_id, score): each task's best documents of each item."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        heaps = Heaps(Index(*shared.value), n, length, df, k)
        most = max(1, CELLS // max(1, len(heaps.heaps)))
        for batch in batches:
            ids, held = batch.column("doc_id").to_pylist(), 0
            chunk: list[list[bytes]] = []
            chunk_ids: list = []
            for doc_id, data in zip(ids, raw(batch.column("text"))):
                words = terms(data)
                if not words:
                    continue
                chunk.append(words)
                chunk_ids.append(doc_id)
                held += len(words)
                if held >= CHUNK_TERMS or len(chunk) >= most:
                    heaps.add(chunk_ids, chunk)
                    chunk, chunk_ids, held = [], [], 0
            if chunk:
                heaps.add(chunk_ids, chunk)
        rows = heaps.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"]
        )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    found = None
    for block in blocks(items, block_bytes):
        index = Index.build([(r.item_id, r.text) for r in block.collect()])
        # plain values: workers need no copy of this package to read them
        shared = spark.sparkContext.broadcast((index.item_ids, index.term_ids, index.starts, index.postings))
        n, length, df = frequencies(docs, shared)
        part = best_of_tasks(docs, shared, n, length, df, k)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
