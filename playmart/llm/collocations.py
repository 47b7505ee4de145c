"""Phrase collocations counted in quotient filters.

Words of a language that occur ``MIN_COUNT`` times or more get a 32-bit id;
all others, and the ends of pieces, break phrases, as no phrase with them can
occur ``MIN_COUNT`` times. A phrase packs its word ids into one key: 64 bits
for two words, 128 for three or four. An invertible permutation (a Feistel
network) spreads the keys evenly; its leading bits are the quotient, all
other bits the remainder, stored in full, so a filter loses nothing: the key
comes back from quotient and remainder. A filter is kept as sorted runs, one
per quotient that occurs, with a counter per remainder.

Every task builds filters of its texts, of bounded size, and sends them in
ranges of quotients; the sorted filters of a range are merged by adding the
counters of equal remainders. Ranges hold even shares of the distinct keys
whatever the phrases are, and a phrase has one counter per filter, so no hot
phrase makes a hot task.

Phrases of two words are counted first. A bitmap of fixed size, with bits for
each frequent one, then tells which longer phrases can be frequent: all their
pairs must be in it. What it lets through by chance is counted exactly too.

Word ids: a tier of ``TIER`` most frequent words is broadcast. Where more
words are frequent, texts that hold them get these words with their ids by a
join, so that the broadcast stays bounded and no word is lost.

Words are split as the texts are, see ``words``; A-Z is lower-cased. Null
text is empty; null lang is ``und``. Rows repeated exactly count each time.
Extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playmart.llm import common
from playmart.llm.common import materialize
from playmart.llm.reversed_search import raw

MIN_COUNT = 30
LONGEST = 4
COVER_NUM, COVER_DEN = 80, 100
SCALE = 2_000_000
TOP = 2_000
UNKNOWN_LANG = "und"

# Words whose ids are broadcast, at most.
TIER = 400_000
# Distinct words, and distinct keys of a filter, that a task holds at most.
WORDS_HELD = 1_000_000
KEYS_HELD = 4_000_000
# Keys of a range of quotients, about, when filters are merged; least ranges.
RANGE_KEYS = 2_000_000
LEAST_RANGES = 64
# Bits of the bitmap of frequent pairs; 8 MB.
BITMAP_BITS = 26
BLOCK_BITS = 15  # bits of the bitmap that one task builds together, as a power
CHUNK_BYTES = 1 << 20

# What ends a piece. The byte 0xFF is never in UTF-8.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
END = b"\xff"
WORD_BYTES = bytes(
    0xFF if b in ENDS else b + 32 if 0x41 <= b <= 0x5A else 0x20 if b == 0x09 else b for b in range(256)
)


def words(data: bytes) -> list[bytes]:
    """The words of a text in order, with ``END`` between pieces."""
    return [w for w in data.translate(WORD_BYTES).replace(END, b" \xff ").split(b" ") if w]


# --------------------------------------------------------------------------
# Words and their ids
# --------------------------------------------------------------------------


def corpus(docs: DataFrame) -> DataFrame:
    """(lang, text) of the texts."""
    return docs.where("text is not null").select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), "text"
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f); the row with a null word has all words of the language."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: dict[str, Counter] = {}
        totals: Counter = Counter()

        def rows():
            flat = [(lang, w, n) for lang, c in found.items() for w, n in c.items() if w != END]
            flat += [(lang, None, n) for lang, n in totals.items()]
            kinds = (pa.string(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in flat], k) for i, k in enumerate(kinds)], ["lang", "word", "f"]
            )

        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), raw(batch.column("text"))):
                held = found.setdefault(lang, Counter())
                text = words(data)
                held.update(text)
                totals[lang] += len(text) - text.count(END)
                if sum(map(len, found.values())) >= WORDS_HELD:
                    yield rows()
                    found.clear()
                    totals.clear()
        yield rows()

    sums = texts.mapInArrow(count, "lang string, word binary, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))
    return materialize(sums.where(f"word is null or f >= {MIN_COUNT}"), "phrase-words")


def top_words(counted: DataFrame, tier: int) -> tuple[DataFrame, int, int]:
    """The words of the broadcast tier, how many these are, and how many there
    are in all: those above a count chosen so that at most ``tier`` qualify."""
    frequent = counted.where("word is not null")
    level = F.floor(F.log2("f") * 16).cast("int")  # a few hundred levels
    levels = frequent.groupBy(level.alias("level")).count().collect()
    held, least = 0, None
    for r in sorted(levels, key=lambda r: -r.level):
        if held + r["count"] > tier:
            break
        held, least = held + r["count"], r.level
    some = frequent.where(level >= least) if least is not None else frequent.limit(0)
    return some, held, sum(r["count"] for r in levels)


def word_ids(counted: DataFrame, tier: int) -> tuple[dict, DataFrame, DataFrame | None]:
    """Ids from 1 on: those of the tier as a dictionary by language, all of
    them as a table (id, lang, word, f), and the table of the others, if any."""
    spark = counted.sparkSession
    some, held, every = top_words(counted, tier)
    rows = sorted((r.lang, bytes(r.word), r.f) for r in some.collect())
    first: dict[str, dict[bytes, int]] = {}
    for i, (lang, word, _) in enumerate(rows, 1):
        first.setdefault(lang, {})[word] = i
    numbered = [(i, r[0], bytearray(r[1]), r[2]) for i, r in enumerate(rows, 1)]
    known = materialize(spark.createDataFrame(numbered, "id long, lang string, word binary, f long"), "phrase-tier")
    if held == every:
        return first, known, None
    # the others: numbered within parts of about 2^17, each after the last
    rest = counted.where("word is not null").join(known.select("lang", "word"), ["lang", "word"], "left_anti")
    n = max(1, (every - held) >> 17)
    rest = rest.withColumn("part", F.pmod(F.xxhash64("lang", "word"), F.lit(n)))
    rest = materialize(
        rest.withColumn("i", F.row_number().over(Window.partitionBy("part").orderBy("lang", "word"))), "phrase-rest"
    )
    offset, offsets = held, []
    for r in rest.groupBy("part").count().orderBy("part").collect():
        offsets.append((r.part, offset))
        offset += r["count"]
    if offset >= 1 << 32:
        raise ValueError("more frequent words than 32-bit ids")
    starts = spark.createDataFrame(offsets, "part long, start long")
    others = materialize(
        rest.join(F.broadcast(starts), "part").select((F.col("start") + F.col("i")).alias("id"), "lang", "word", "f"), "phrase-others"
    )
    return first, known.unionByName(others), others


def outside(data: bytes, known: dict) -> list[bytes]:
    """The distinct words of a text that are not known; the tier is looked
    into word by word, as walking or copying it would cost more than the text."""
    return [w for w in set(words(data)) if w not in known and w != END]


def with_others(texts: DataFrame, shared, others: DataFrame | None) -> DataFrame:
    """``texts`` with the column ``more``: the words outside the tier that
    have an id, with it (null where there are none)."""
    kind = "array<struct<word: binary, id: bigint>>"
    if others is None:
        return texts.withColumn("more", F.lit(None).cast(kind))

    def missing(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tier = shared.value
        for batch in batches:
            out = []
            keys = batch.column("text_key").to_pylist()
            for lang, data, key in zip(batch.column("lang").to_pylist(), raw(batch.column("text")), keys):
                out += [(key, lang, w) for w in outside(data, tier.get(lang, {}))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.string(), pa.binary()))],
                ["text_key", "lang", "word"],
            )

    keyed = texts.withColumn("text_key", F.xxhash64("lang", "text"))
    found = (
        keyed.mapInArrow(missing, "text_key long, lang string, word binary")
        .join(others.select("lang", "word", "id"), ["lang", "word"])
        .groupBy("text_key")
        .agg(F.collect_set(F.struct("word", "id")).alias("more"))  # as long as a text at most
    )
    return materialize(keyed.join(found, "text_key", "left").select("lang", "text", F.col("more").cast(kind)), "phrase-texts")


def sequences(batch, tier: dict) -> Iterator:
    """Arrays of word ids of the batch's texts, 0 where phrases break."""
    import numpy as np

    chunks: dict[str, tuple[list[bytes], dict[bytes, int]]] = {}
    for lang, data, extra in zip(batch.column("lang").to_pylist(), raw(batch.column("text")), batch.column("more").to_pylist()):
        held, more = chunks.setdefault(lang, ([], {}))
        held.append(data)
        # a word has one id in its language, whichever text it comes with
        more.update((x["word"], x["id"]) for x in extra or ())
        if sum(map(len, held)) >= CHUNK_BYTES:
            yield joined(*chunks.pop(lang), tier.get(lang, {}))
    for lang, chunk in chunks.items():
        yield joined(*chunk, tier.get(lang, {}))


def joined(texts: list[bytes], more: dict, ids: dict):
    import numpy as np

    text = words(END.join(texts))
    found = np.fromiter(map(ids.get, text, repeat(0)), np.uint64, len(text))
    if more:
        open_ = np.flatnonzero(found == 0)
        found[open_] = np.fromiter((more.get(text[i], 0) for i in open_.tolist()), np.uint64, len(open_))
    return found


# --------------------------------------------------------------------------
# Quotient filters
# --------------------------------------------------------------------------

# Odd constants of the mixing rounds.
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def mixed(x, constant: int):
    import numpy as np

    x = (x ^ (x >> np.uint64(31))) * np.uint64(constant)
    return x ^ (x >> np.uint64(29))


def permuted(hi, lo, back: bool = False, bits: int = 64):
    """Feistel network on two halves of ``bits`` bits; ``back`` inverts it."""
    import numpy as np

    mask = np.uint64((1 << bits) - 1)
    for i in reversed(range(len(ROUNDS))) if back else range(len(ROUNDS)):
        if i % 2:
            hi = hi ^ (mixed(lo, ROUNDS[i]) & mask)
        else:
            lo = lo ^ (mixed(hi, ROUNDS[i]) & mask)
    return hi, lo


class QuotientFilter:
    """Counters of permuted keys, sorted by quotient and remainder.

    ``width`` is 64 or 128 bits. ``hi`` leads with the quotient; ``lo`` is
    the other half of a wide key (None for a narrow one).
    """

    def __init__(self, width: int):
        import numpy as np

        self.wide = width == 128
        empty = np.zeros(0, np.uint64)
        self.hi, self.lo, self.n = empty, empty if self.wide else None, np.zeros(0, np.int64)
        self.waiting: list = []
        self.held = 0

    def add(self, first, second, n=None) -> None:
        """Counts keys given as two halves; equal keys may repeat."""
        import numpy as np

        if self.wide:
            hi, lo = permuted(first, second)
        else:
            a, b = permuted(first, second, bits=32)
            hi, lo = a << np.uint64(32) | b, None
        self.put(hi, lo, np.ones(len(hi), np.int64) if n is None else n)

    def put(self, hi, lo, n) -> None:
        """Counts permuted keys."""
        part = self.summed(hi, lo, n)
        self.waiting.append(part)
        self.held += len(part[0])
        if self.held > 2 * len(self.hi) + 500_000:
            self.settle()

    def summed(self, hi, lo, n):
        import numpy as np

        order = np.lexsort((lo, hi)) if self.wide else np.argsort(hi, kind="stable")
        hi, n = hi[order], n[order]
        lo = lo[order] if self.wide else None
        new = np.ones(len(hi), bool)
        new[1:] = hi[1:] != hi[:-1]
        if self.wide:
            new[1:] |= lo[1:] != lo[:-1]
        at = np.flatnonzero(new)
        return hi[at], lo[at] if self.wide else None, np.add.reduceat(n, at) if len(at) else n

    def settle(self) -> None:
        """Merges what waits into the sorted filter."""
        import numpy as np

        parts = [(self.hi, self.lo, self.n), *self.waiting]
        self.hi, self.lo, self.n = self.summed(
            np.concatenate([p[0] for p in parts]),
            np.concatenate([p[1] for p in parts]) if self.wide else None,
            np.concatenate([p[2] for p in parts]),
        )
        self.waiting, self.held = [], 0

    def __len__(self) -> int:
        return len(self.hi) + self.held

    def ranges(self, bits: int) -> Iterator[tuple]:
        """(range, quotients, runs, remainders, counters): the sorted filter
        cut at the leading ``bits`` bits. Within a range the quotient is the
        next 16 bits; ``runs`` has how many remainders each one has."""
        import numpy as np

        self.settle()
        top = (self.hi >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(top)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(top)]):
            if a == b:
                continue
            q = (self.hi[a:b] >> np.uint64(48 - bits)).astype(np.uint16)
            quotients, runs = np.unique(q, return_counts=True)
            rest = self.hi[a:b] & np.uint64((1 << (48 - bits)) - 1)
            # six bytes hold what of hi is left
            remainders = rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            if self.wide:
                remainders += self.lo[a:b].astype("<u8").tobytes()
            yield int(top[a]), quotients.tobytes(), runs.astype("<u4").tobytes(), remainders, self.n[a:b].astype("<i8").tobytes()

    def load(self, bits: int, row: tuple) -> None:
        """Adds the counters of a range that ``ranges`` gave."""
        import numpy as np

        top, quotients, runs, remainders, counters = row
        n = np.frombuffer(counters, "<i8").astype(np.int64)
        q = np.repeat(np.frombuffer(quotients, np.uint16), np.frombuffer(runs, "<u4")).astype(np.uint64)
        rest = np.zeros((len(n), 8), np.uint8)
        rest[:, :6] = np.frombuffer(remainders, np.uint8, 6 * len(n)).reshape(-1, 6)
        hi = np.uint64(top) << np.uint64(64 - bits) | q << np.uint64(48 - bits) | rest.reshape(-1).view("<u8")
        lo = np.frombuffer(remainders, "<u8", len(n), 6 * len(n)).astype(np.uint64) if self.wide else None
        self.put(hi, lo, n)

    def frequent(self, least: int):
        """First halves, second halves and counts of the keys that occur
        ``least`` times or more."""
        import numpy as np

        self.settle()
        some = self.n >= least
        hi = self.hi[some]
        if self.wide:
            first, second = permuted(hi, self.lo[some], back=True)
        else:
            first, second = permuted(hi >> np.uint64(32), hi & np.uint64(0xFFFFFFFF), back=True, bits=32)
        return first, second, self.n[some]


SHARDS = "range long, quotients binary, runs binary, remainders binary, counters binary"


def bits_of(first, second):
    """Two places in the bitmap for each pair of word ids."""
    import numpy as np

    a, b = permuted(first, second, bits=32)
    mask = np.uint64((1 << BITMAP_BITS) - 1)
    return [mixed(a << np.uint64(32) | b, c) >> np.uint64(20) & mask for c in ROUNDS[:2]]


def filters(texts: DataFrame, shared, bitmap, bits: int) -> DataFrame:
    """The filters of every task, by range: pairs without a bitmap, phrases of
    three and four words with one."""

    def build(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tier = shared.value
        pairs_of = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap.value, np.uint8))
        width = 64 if bitmap is None else 128
        held = QuotientFilter(width)

        def rows(full):
            kinds = (pa.int64(), *[pa.binary()] * 4)
            names = ["range", "quotients", "runs", "remainders", "counters"]
            for row in full.ranges(bits):
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

        for batch in batches:
            for ids in sequences(batch, tier):
                if len(ids) < 2:
                    continue
                a, b = ids[:-1], ids[1:]
                ok = (a > 0) & (b > 0)
                if pairs_of is None:
                    held.add(a[ok], b[ok])
                else:
                    at = np.flatnonzero(ok)
                    one, two = bits_of(a[at], b[at])
                    ok[at] = (pairs_of[one] & pairs_of[two]).astype(bool)
                    three = np.flatnonzero(ok[:-1] & ok[1:])
                    hi = ids[three] << np.uint64(32) | ids[three + 1]
                    held.add(hi, ids[three + 2] << np.uint64(32))
                    four = np.flatnonzero(ok[:-2] & ok[1:-1] & ok[2:])
                    hi = ids[four] << np.uint64(32) | ids[four + 1]
                    held.add(hi, ids[four + 2] << np.uint64(32) | ids[four + 3])
                if len(held) >= KEYS_HELD:
                    yield from rows(held)
                    held = QuotientFilter(width)
        yield from rows(held)

    return texts.mapInArrow(build, SHARDS)


def merged(shards: DataFrame, bits: int, width: int) -> DataFrame:
    """(ids, f) of the keys that all filters together hold often enough."""

    def merge(shard):  # the filters of one range
        import numpy as np
        import pyarrow as pa

        whole = QuotientFilter(width)
        for batch in shard.to_batches():
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                whole.load(bits, row)
        first, second, n = whole.frequent(MIN_COUNT)
        if width == 64:
            ids = np.stack([first, second], axis=1).astype(np.int64)
            size = np.full(len(n), 2)
        else:
            low = np.uint64(0xFFFFFFFF)
            ids = np.stack([x for h in (first, second) for x in (h >> np.uint64(32), h & low)], axis=1).astype(np.int64)
            size = 3 + (ids[:, 3] > 0)
        flat = ids.reshape(-1)
        flat = flat[(np.arange(ids.shape[1]) < size[:, None]).reshape(-1)]
        ends = np.concatenate([[0], np.cumsum(size)])
        return pa.Table.from_arrays(
            [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())), pa.array(n, pa.int64())], ["ids", "f"]
        )

    return materialize(shards.groupBy("range").applyInArrow(merge, "ids array<bigint>, f long"), "phrase-counts")


def bitmap_of(pairs: DataFrame) -> bytes:
    """The bitmap of the pairs: built in blocks, which come to the driver
    packed, 8 MB in all whatever the number of pairs."""

    def places(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("ids").flatten().to_numpy().astype(np.uint64).reshape(-1, 2)
            at = np.unique(np.concatenate(bits_of(ids[:, 0], ids[:, 1]))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> BLOCK_BITS), pa.array(at & ((1 << BLOCK_BITS) - 1))], ["block", "at"])

    def pack(places):
        import numpy as np
        import pyarrow as pa

        on = np.zeros(1 << BLOCK_BITS, np.uint8)
        on[places.column("at").to_numpy()] = 1
        block = places.column("block")[0].as_py()
        return pa.Table.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(on).tobytes()], pa.binary())], ["block", "bits"])

    at = pairs.select("ids").mapInArrow(places, "block long, at long").distinct()
    size = 1 << (BLOCK_BITS - 3)
    out = bytearray(1 << (BITMAP_BITS - 3))
    for r in at.groupBy("block").applyInArrow(pack, "block long, bits binary").collect():
        out[r.block * size : (r.block + 1) * size] = r.bits
    return bytes(out)


# --------------------------------------------------------------------------
# Phrases and their scores
# --------------------------------------------------------------------------


def phrases(docs: DataFrame, tier: int = TIER) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of two to ``LONGEST`` words that occur often enough as (ids,
    f), the words (id, lang, word, f), and (lang, n) of all words."""
    texts = corpus(docs)
    spark = docs.sparkSession
    counted = word_counts(texts)
    totals = counted.where("word is null").select("lang", F.col("f").alias("n"))
    first, known, others = word_ids(counted, tier)
    shared = spark.sparkContext.broadcast(first)
    texts = with_others(texts, shared, others)
    n = totals.agg(F.sum("n")).first()[0] or 0
    bits = max(LEAST_RANGES, n // RANGE_KEYS).bit_length()
    pairs = merged(filters(texts, shared, None, bits), bits, 64)
    bitmap = spark.sparkContext.broadcast(bitmap_of(pairs))
    longer = merged(filters(texts, shared, bitmap, bits), bits, 128)
    return pairs.unionByName(longer), known, totals


def collocations(docs: DataFrame, top: int = TOP, tier: int = TIER) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each
    language by the score of their weakest cut."""
    found, known, totals = phrases(docs, tier)
    every = found.unionByName(known.select(F.array("id").alias("ids"), "f"))
    size = F.size("ids")
    cuts = found.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "*", F.expr("slice(ids, 1, k)").alias("left"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("right")
    )
    lefts = every.select(F.col("ids").alias("left"), F.col("f").alias("l"))
    rights = every.select(F.col("ids").alias("right"), F.col("f").alias("r"))
    exact = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"CAST({SCALE} AS DECIMAL(7, 0)) * {exact('a')} div ({exact('l')} + {exact('r')})")
    scored = (
        cuts.join(lefts, "left")
        .join(rights, "right")
        .select("ids", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("ids", "a")
        .agg(F.min("cut").alias("cut"))
    )
    # the most frequent longer phrase that holds a phrase
    inner = found.where(size > 2).select(
        "f",
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(ids) - 1), m -> "
                "transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m))))"
            )
        ).alias("ids"),
    )
    covers = inner.groupBy("ids").agg(F.max("f").alias("cover"))
    kept = (
        scored.join(covers, "ids", "left")
        .where(F.expr(f"cover IS NULL OR {exact('cover')} * {COVER_DEN} < {exact('a')} * {COVER_NUM}"))
        .select(F.xxhash64("ids").alias("at"), "ids", "a", "cut.*")
    )
    # ids back to words
    spelled = (
        kept.select("ids", "a", "l", "r", "score", F.posexplode("ids").alias("i", "id"))
        .join(known.select("id", "lang", F.col("word").cast("string").alias("word")), "id")
        .groupBy("ids", "a", "l", "r", "score")
        .agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
        .select("lang", F.array_join(F.col("w.word"), " ").alias("phrase"), "a", "l", "r", "score")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = spelled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
