"""Byte-level BPE encoding and decoding with forced-boundary splitting.

A pair of bytes that occurs inside no token of the vocabulary can never be
merged across, so a cut between such bytes is certain. Two uses:

1. A text is cut at the forced pairs before white space that follows a
   character which is not white space. The pre-tokenizer also always ends a
   piece there, so each fragment encodes on its own as it does in the text.
   Fragments are looked up in a bounded worker cache.
2. A fragment missing from the cache is split by the library's
   pre-tokenizer, and every pre-token is cut again at all of its forced byte
   pairs; each part goes through the vocabulary's BPE model alone.

The ids of the parts are concatenated. A text with white space outside ASCII
is one fragment; one that holds an added token's string is encoded by the
library, which gives that string its own id.

Null text is the empty text (no ids). Repeated rows give repeated rows; extra
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm import common, vocab

# ids: little-endian unsigned 32-bit integers, one after the other
SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"
SPACE = " \t\n\r\x0b\x0c"
OTHER_SPACE = re.compile(r"[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def inner_pairs(token_bytes: list[bytes]) -> bytearray:
    """1 at ``256 * x + y`` if the bytes x, y stand side by side in a token."""
    inner = bytearray(65_536)
    for token in token_bytes:
        for x, y in zip(token, token[1:]):
            inner[x << 8 | y] = 1
    return inner


class Codec:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, path: str):
        self.words = vocab.Vocabulary(path)
        if self.words.suffix:
            raise ValueError("forced boundaries need a vocabulary without a word-end suffix")
        self.inner = inner_pairs(self.words.token_bytes)
        # pairs before white space that do occur inside a token: no cut there
        self.unforced = [
            bytes((x, ord(c))) for c in SPACE for x in range(256) if chr(x) not in SPACE and self.inner[x << 8 | ord(c)]
        ]
        self.fragments = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.pieces = vocab.Cache()

    def cut(self, piece: bytes) -> list[bytes]:
        """The parts of a pre-token between its forced boundaries."""
        at = [i for i in range(1, len(piece)) if not self.inner[piece[i - 1] << 8 | piece[i]]]
        return [piece[a:b] for a, b in zip([0, *at], [*at, len(piece)])]

    def piece(self, token: str) -> bytes:
        """Ids of a pre-token, part by part."""
        ids = array("I")
        for part in self.cut(token.encode("utf-8", "replace")):
            ids.extend(self.words.merge(part))
        return self.pieces.put(token, ids.tobytes())

    def fragment(self, text: str) -> bytes:
        return b"".join([self.pieces.get(t) or self.piece(t) for t in self.words.pre_tokens(text)])

    def split(self, text: str) -> list[str]:
        """Fragments between certain cuts before white space."""
        if OTHER_SPACE.search(text):
            return [text]
        found = self.fragments(text)
        data = text.encode("utf-8", "replace") if self.unforced else b""
        if any(pair in data for pair in self.unforced):
            joined: list[str] = []
            for f in found:
                if joined and (joined[-1][-1] + f[0]).encode("utf-8", "replace")[-2:] in self.unforced:
                    joined[-1] += f
                else:
                    joined.append(f)
            return joined
        return found

    def encode(self, text: str) -> bytes:
        if self.words.has_special(text):
            return array("I", self.words.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        pieces, cache = self.split(text), self.words.cache
        found = list(map(cache.new.get, pieces))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    ids = cache.get(pieces[i])
                    found[i] = cache.put(pieces[i], self.fragment(pieces[i])) if ids is None else ids
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.words.token_bytes.__getitem__, array("I", ids))).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """Ids of every whole text and the text decoded from them."""

    def code(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = common.worker_state(f"bpe:{path}", lambda: Codec(path))
        for batch in batches:
            keys, found = batch.column("doc_id"), common.texts(batch.column("text"))
            # small output batches: long texts give long id lists
            for a in range(0, len(found), 500):
                ids = [codec.encode(t) for t in found[a : a + 500]]
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.slice(a, len(ids)),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array([codec.decode(x) for x in ids], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(code, SCHEMA)
