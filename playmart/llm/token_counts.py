"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast hash table of the lengths, in tokens, of frequent
pre-tokens; its size is a parameter and does not grow with the corpus. Tier
two is a bounded cache in each Python worker, filled by the vocabulary's own
BPE model. Pre-tokens are never shuffled; a document is counted where it is
read.

The frequent pre-tokens come from a bounded sample (about ``SAMPLE_DOCS``
texts at random, ``SAMPLE_CHARS`` characters of each). The sample decides
only which lookups are fast; every text is counted whole and exactly.

Null text counts as empty: 0 bytes, 0 tokens. Repeated rows give repeated
rows; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm import common, vocab

SAMPLE_DOCS = 2_000
SAMPLE_CHARS = 4_000
TABLE_ENTRIES = 50_000
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


class Counting:
    """Splits texts into pre-tokens in this process."""

    def __init__(self, path: str):
        self.words = vocab.Vocabulary(path)

    def length(self, token: str) -> int:
        n = self.words.cache.get(token)
        return n or self.words.cache.put(token, len(self.words.merge(token.encode("utf-8", "replace"))))

    def count(self, text: str, table: dict[str, int]) -> int:
        if self.words.has_special(text):
            return len(self.words.tokenizer.encode(text, add_special_tokens=False).ids)
        tokens = self.words.pre_tokens(text)
        known = sum(filter(None, map(table.get, tokens)))
        return known + sum(map(self.length, [t for t in tokens if t not in table]))


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens of a bounded sample."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    sample = docs.select(F.substring("text", 1, SAMPLE_CHARS).alias("t")).where("t is not null").sample(share, seed=7).collect()
    counting = Counting(path)
    seen: Counter[str] = Counter()
    for row in sample:
        seen.update(counting.words.pre_tokens(row.t))
    return {t: counting.length(t) for t, _ in seen.most_common(TABLE_ENTRIES)}


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every whole text, for a byte-level file."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counting = common.worker_state(f"counts:{path}", lambda: Counting(path))
        lengths = shared.value
        for batch in batches:
            found = common.texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t.encode()) for t in found], pa.int64()),
                    pa.array([counting.count(t, lengths) for t in found], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(count, SCHEMA)
