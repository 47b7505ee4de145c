"""Encoding, decoding and counting against the tokenizer library itself."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from playmart.llm import bpe, queries, token_counts
from playmart.llm.common import table

from .conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", None, " ", "  ", "   a", "a \n  b", "a\n \tb", "!'s it's  'S", "a b　c d\x85 e", "\x1c a\x1c\x1cb !\x1c'll",
    "x<|endoftext|>y <|endoftext|>", "ab\x00c", "日本語 テキスト，。", "😀😀 a😀'm", "a" * 5000, "q՘ ꟎ z", "É́tre\r\n\r\n  fin ",
    "12 345 ६७", "same", "same",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_odd_texts(docs_of, library):
    docs = docs_of(ODD)
    got = {r.doc_id: r for r in bpe.encode_decode(docs, PATH).collect()}
    counts = {r.doc_id: r for r in token_counts.token_counts(docs, PATH).collect()}
    assert len(got) == len(counts) == len(ODD)
    for i, t in enumerate(ODD):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids, repr(t)
        assert got[i].n_tokens == counts[i].n_tokens == len(ids), repr(t)
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
        assert counts[i].n_bytes == len((t or "").encode())


def test_empty_table(docs_of):
    assert bpe.encode_decode(docs_of([]), PATH).count() == 0
    assert token_counts.token_counts(docs_of([]), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'!sdl\x1c\xa0ab1"), st.characters(codec="utf-8")), max_size=30))
def test_any_text(text):
    library = _once("lib", lambda: Tokenizer.from_file(PATH))
    codec, counting = _once("codec", lambda: bpe.Codec(PATH)), _once("count", lambda: token_counts.Counting(PATH))
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids
    assert codec.decode(codec.encode(text)) == text
    assert counting.count(text, {}) == len(ids)


KEPT: dict = {}


def _once(key, build):
    if key not in KEPT:
        KEPT[key] = build()
    return KEPT[key]


def test_queries_match_library(spark, library):
    text = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    a = {r.doc_id: r for r in queries.op7_forced_boundary_bpe(spark, SF).collect()}
    b = {r.doc_id: r for r in queries.op9_token_counts(spark, SF).collect()}
    assert len(a) == len(b) == len(text)
    for k, t in text.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert a[k].n_tokens == b[k].n_tokens == len(ids)
        assert a[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert a[k].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert b[k].n_bytes == len(t.encode()) and b[k].over_limit == (len(ids) > 1024)
