"""Packing: gapless full sequences, every id once, ids of the library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playmart.llm import packing, queries
from playmart.llm.common import table

from .conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def check(rows, wanted, capacity):
    """wanted: a list of (doc_id, ids), repeated rows included."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.start, r.length, r.doc_tokens, r.crc))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= capacity and (at == capacity or at & (at - 1) == 0)
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in wanted)
    for doc_id in {k for k, _ in wanted}:
        expected = [ids for k, ids in wanted if k == doc_id]
        found = sorted(by_doc[doc_id])
        if len(expected) == 1:
            at = 0
            for start, length, total, crc in found:
                assert start == at and total == len(expected[0])
                assert crc == zlib.crc32(np.array(expected[0][start : start + length], "<u4").tobytes())
                at += length
            assert at == len(expected[0])
        else:
            assert sum(x[1] for x in found) == sum(map(len, expected))


ODD = [
    "", None, "  ", "\n", "one two", "It's   HELLO's, WORLD!..", "x<|endoftext|>y <|startoftext|>", "Éa É ßẞ Ünï İstanbul ΣΑΣ",
    "a b　c\x85d\x1ce", "日本語 123 4.5", "word " * 9000, "z" * 3000, "same", "same", "µ ªº ÿŸ co.,;:!?", "K\u212a ½²",
]


def test_odd_texts(docs_of, library):
    from pyspark.sql import functions as F

    ids = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in ODD]
    got = packing.pack(docs_of(ODD), PATH, 2).withColumn("crc", F.crc32("ids")).collect()
    check(got, list(enumerate(ids)), 4096)


def test_repeated_rows_and_null_ids(docs_of, library):
    from pyspark.sql import functions as F

    found = ["a b c"] * 300 + ["lone"]
    keys = [7] * 300 + [None]
    got = packing.pack(docs_of(found, ids=keys), PATH, 2, shard_bytes=200).withColumn("crc", F.crc32("ids")).collect()
    check(got, [(k, library.encode(t, add_special_tokens=False).ids + [2]) for k, t in zip(keys, found)], 4096)
    assert len({r.sequence_id >> 32 for r in got}) > 5


def test_empty_table(docs_of):
    assert packing.pack(docs_of([]), PATH, 2).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_assign(lengths):
    lengths = sorted(lengths, reverse=True)
    out = packing.assign(lengths, 64)
    used = defaultdict(int)
    for piece, _, length, _, _ in out:
        used[piece] += length
    assert [used[i] for i in range(len(lengths))] == lengths
    sizes = defaultdict(int)
    for _, _, length, at, offset in out:
        assert offset == sizes[at]
        sizes[at] += length
    assert all(s == 64 or s & (s - 1) == 0 for s in sizes.values())


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    lengths = sorted((int(x) for x in rng.integers(1, 3000, 3000)), reverse=True)
    cost = defaultdict(float)
    for _, _, length, at, _ in packing.assign(lengths, 4096):
        cost[at] += packing.piece_cost(length)
    full = sorted(cost.values())[12:]
    assert np.std(full) / np.mean(full) < 0.12


def test_query(spark, library):
    from pyspark.sql import functions as F

    got = queries.op3_cost_balanced_packing(spark, SF).withColumnRenamed("ids_crc32", "crc").collect()
    docs = [(r.doc_id, r.text or "") for r in table(spark, SF, "documents").collect()]
    check(got, [(k, library.encode(t, add_special_tokens=False).ids + [2]) for k, t in docs], 4096)
    assert dict(queries.op3_cost_balanced_packing(spark, SF).dtypes)["ids_crc32"] == "bigint"
