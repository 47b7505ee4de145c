"""Cost-balanced packing of token sequences.

Every document is tokenized whole, gets an end id, and is cut into pieces of
at most ``capacity`` ids. Pieces go to shards by hash (bounded work per task,
no matter which source or document is hot). In a shard the piece costs are
estimated as linear plus quadratic in their length (feed-forward and
attention work), and the pieces, in descending order, each go to the
sequence of lowest cost that has room. A piece that fits nowhere is cut over
the sequences of lowest cost that still have room.

A shard opens exactly ``total // capacity`` sequences and gives the rest of
its ids to sequences of power-of-two length (its binary digits), which need
no padding; so every sequence is full. At most log2(capacity) sequences of a
shard are short.

Null text is the empty text: one piece with the end id alone. Repeated rows
are packed as often as they occur; extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm import common, vocab

CAPACITY = 4096
# Text bytes of one shard, on average: a few hundred sequences.
SHARD_BYTES = 8 << 20
# Attention cost over linear cost is length / (6 * width) for this model width.
MODEL_WIDTH = 2048

PIECES = "doc_id long, start long, doc_tokens long, ids binary, shard long"
# ids: little-endian unsigned 32-bit integers
PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

# In texts of ASCII and Latin-1 letters without apostrophes normal form, case and
# split are plain: runs of letters and of other characters are pre-tokens
# (or several of them) whatever stands around them. Finds what other texts hold.
ODD_TEXT = re.compile(r"[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|'")
RUNS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[^ \na-z\u00df-\u00f6\u00f8-\u00ff]+").findall
BLANKS = str.maketrans("\n\t\r", "   ")


class WordCoder:
    """Encodes words through a bounded cache.

    For vocabularies that split at white space and drop it, the ids of a
    word, or of a run of letters, do not depend on its neighbours.
    """

    def __init__(self, path: str):
        self.words = vocab.Vocabulary(path)
        self.code = "H" if len(self.words.token_bytes) <= 65_536 else "I"

    def word(self, word: str, plain: bool) -> bytes:
        if plain and word.isalpha():
            ids = self.words.merge(word.encode())
        else:
            ids = self.words.tokenizer.encode(word, add_special_tokens=False).ids
        return array(self.code, ids).tobytes()

    def encode(self, text: str) -> bytes:
        plain = not ODD_TEXT.search(text) and not self.words.has_special(text)
        words = RUNS(text.lower()) if plain else text.translate(BLANKS).split(" ")
        cache = self.words.cache
        found = list(map(cache.new.get, words))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    ids = cache.get(words[i])
                    found[i] = cache.put(words[i], self.word(words[i], plain)) if ids is None else ids
        return b"".join(found)


def piece_cost(length, width: int = MODEL_WIDTH):
    """Estimated work of a piece: linear plus quadratic in its length."""
    return length + length * length / (6.0 * width)


def assign(lengths: list[int], capacity: int, width: int = MODEL_WIDTH) -> list[tuple[int, int, int, int, int]]:
    """(piece, start in it, length, sequence, offset) for pieces given in
    descending order; every sequence ends up full."""
    import numpy as np

    total = int(sum(lengths))
    rest = total % capacity
    tail = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    size = np.array([capacity] * (total // capacity) + tail, dtype=np.int64)
    room, cost, out, unplaced = size.copy(), np.zeros(len(size)), [], []

    def put(piece: int, start: int, length: int, at: int) -> None:
        out.append((piece, start, length, at, int(size[at] - room[at])))
        room[at] -= length
        cost[at] += piece_cost(length, width)

    for piece, length in enumerate(lengths):
        fit = np.where(room >= length, cost, np.inf)
        at = int(fit.argmin()) if len(fit) else 0
        if len(fit) and fit[at] < np.inf:
            put(piece, 0, length, at)
        else:
            unplaced.append(piece)
    for piece in unplaced:
        start = 0
        while start < lengths[piece]:
            at = int(np.where(room > 0, cost, np.inf).argmin())
            length = min(int(room[at]), lengths[piece] - start)
            put(piece, start, length, at)
            start += length
    return out


def pieces(docs: DataFrame, path: str, end_id: int, capacity: int, shards: int) -> DataFrame:
    """Every document's ids in pieces of at most ``capacity``, with a shard."""

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import xxhash

        coder = common.worker_state(f"words:{path}", lambda: WordCoder(path))
        width = array(coder.code).itemsize
        end = array(coder.code, [end_id]).tobytes()
        seen: dict[int, int] = {}  # equal rows of this task, so that many copies spread over the shards
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), common.texts(batch.column("text"))):
                ids = coder.encode(text) + end
                n = len(ids) // width
                row = xxhash.xxh64_intdigest(f"{doc_id}\0{text}".encode("utf-8", "replace"))
                copy = seen[row] = seen.get(row, -1) + 1
                for start in range(0, n, capacity):
                    shard = xxhash.xxh64_intdigest(f"{row} {copy} {start}") % shards
                    rows.append((doc_id, start, n, ids[start * width : (start + capacity) * width], shard))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[i] for r in rows], kind)
                    for i, kind in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))
                ],
                ["doc_id", "start", "doc_tokens", "ids", "shard"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def pack(
    docs: DataFrame,
    path: str,
    end_id: int,
    capacity: int = CAPACITY,
    shard_bytes: int = SHARD_BYTES,
    width: int = MODEL_WIDTH,
) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    total = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    cut = pieces(docs, path, end_id, capacity, shards)

    def fill(group):
        import numpy as np
        import pyarrow as pa

        rows = list(zip(*(group.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))))
        shard = group.column("shard")[0].as_py()
        wide = common.worker_state(f"words:{path}", lambda: WordCoder(path)).code == "I"
        kind = "<u4" if wide else "<u2"
        rows.sort(key=lambda r: (-len(r[3]), -1 if r[0] is None else r[0], r[1], r[3]))
        ids = [np.frombuffer(r[3], kind) for r in rows]
        out: dict[str, list] = {c.split()[0]: [] for c in PACKED.split(", ")}
        for piece, start, length, sequence, offset in assign([len(x) for x in ids], capacity, width):
            doc_id, first, doc_tokens, _ = rows[piece]
            found = (
                doc_id,
                first + start,
                length,
                ids[piece][start : start + length].astype("<u4").tobytes(),
                doc_tokens,
                (shard << 32) + sequence,
                offset,
            )
            for column, value in zip(out.values(), found):
                column.append(value)
        kinds = {"ids": pa.binary()}
        return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    return cut.groupBy("shard").applyInArrow(fill, PACKED)
