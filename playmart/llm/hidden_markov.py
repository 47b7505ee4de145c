"""Hidden Markov language model, trained by Baum-Welch on Spark.

``STATES`` latent states emit words; a text is its words and one end. Each
Baum-Welch step is one pass over the training texts: every task runs the
scaled forward and backward recursions over whole texts and sums expected
starts, moves between states and emissions; the sums are added up by
aggregates.

* Words: a tier of the most frequent words, at most ``TIER``, are symbols of
  their own in all steps; every other word stands for its form (a hash of
  its ending and length, ``FORMS`` of them) until the last step. That step
  counts expected emissions per word for the whole vocabulary, a distributed
  table that grows with the corpus; it never reaches the driver.
* All ``STEPS`` steps see all training texts, whole. Those before the last
  read them as symbols, which are looked up once.
* With c(w, s) the expected count of word w in state s, p(s) the share of
  the state, N training tokens and V distinct ones, state s emits w with
  probability ``(c(w, s) / p(s) + 0.5) / (N + 0.5 (V + 1))``: they sum to 1
  over the vocabulary and one unknown word, which gets the probability that
  the smoothed unigram base gives it.
* Scoring looks up the tier in a broadcast of bounded size and other words by
  a join of (text, word) pairs with the word table; the exact likelihood
  comes from the scaled forward recursion over the whole text.

Counts are summed in fixed point, so they do not depend on the order of rows.
Texts are told apart by 64-bit hashes. Null text is empty: one token, the
end. A null doc_id is not held out. Rows repeated exactly count each time in
training and are scored alike. Extra columns are ignored. An empty table
gives an empty table; without training texts every score is 0.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import materialize, released

STATES = 8
TIER = 150_000
FORMS = 4_096
STEPS = 10
SEED = 11

END = b""  # no word is empty
# Fixed point of expected counts; shares of a word's states add up to SHARES.
UNIT = 1 << 20
SHARES = (1 << 16) - 1
# Tokens whose recursions run together, and words a task holds, at most.
CHUNK_TOKENS = 400_000
WORDS_HELD = 250_000
SEEN_TEXTS = 200_000
PART_TEXTS = 500

# Symbols of the sums that are no emissions: starts and moves from a state.
_STARTS, _MOVES = -1, -2

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def words_of(column):
    """The words of an Arrow column of texts one after the other, A-Z
    lower-cased, with an empty word as the end of each text; and the number
    of words of each text, its end included. Null is the empty text."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lowered = pc.fill_null(pc.ascii_lower(column.cast(pa.string())), "")
    # with a space behind, white space splits off one empty word at the end
    lists = pc.ascii_split_whitespace(pc.binary_join_element_wise(lowered, " ", ""))
    flat = lists.flatten().cast(pa.binary())
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    kept = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    kept[ends - 1] = True  # not the empty word that white space at the start leaves
    counts = np.diff(np.concatenate([[0], np.cumsum(kept)[ends - 1]])) if len(ends) else np.zeros(0, np.int64)
    return flat.filter(pa.array(kept)), counts


def places_in(words, tier):
    """The place of each word in the Arrow array ``tier``, -1 if it is not there."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.index_in(words, value_set=tier), -1).to_numpy(zero_copy_only=False).astype("int64")


def form(word: bytes) -> int:
    """The form of a word: its ending and length, hashed."""
    return zlib.crc32(word[-3:] + bytes((min(len(word), 12),))) % FORMS


# --------------------------------------------------------------------------
# Vocabulary
# --------------------------------------------------------------------------


def parts_of(batch, column: str = "text"):
    """A batch in parts of at most ``PART_TEXTS`` rows, texts of like lengths
    together: the recursions take as many steps as the longest text of a
    chunk has tokens. The texts are in the column ``column``."""
    import pyarrow.compute as pc

    batch = batch.take(pc.array_sort_indices(pc.binary_length(batch.column(column))))
    for a in range(0, batch.num_rows, PART_TEXTS):
        yield batch.slice(a, PART_TEXTS)


def word_counts(train: DataFrame) -> DataFrame:
    """(word, f) of the training texts, ends included."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(found):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "f"]
            )

        found: Counter = Counter()
        for batch in batches:
            for part in parts_of(batch):
                counts = words_of(part.column("text"))[0].value_counts()
                for word, n in zip(counts.field(0).to_pylist(), counts.field(1).to_pylist()):
                    found[word] += n
                if len(found) >= 2 * WORDS_HELD:
                    yield rows(found)
                    found = Counter()
        yield rows(found)

    return train.select("text").mapInArrow(count, "word binary, f long").groupBy("word").agg(F.sum("f").alias("f"))


LEVEL = "CAST(floor(log2(f) * 16) AS INT)"


def tier_level(counted: DataFrame, tier: int) -> int:
    """The least level of count (a few hundred there are) from which on at
    most ``tier`` words are left."""
    held, least = 0, 1 << 30
    levels = counted.groupBy(F.expr(LEVEL).alias("level")).count().collect()
    for r in sorted(levels, key=lambda r: -r.level):
        if held + r["count"] > tier:
            break
        held, least = held + r["count"], r.level
    return least


# --------------------------------------------------------------------------
# Recursions over many texts at once
# --------------------------------------------------------------------------


class Layout:
    """Texts, longest first, laid out by position: at position t the texts
    longer than t stand side by side."""

    def __init__(self, lengths):
        import numpy as np

        self.active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        self.at = np.concatenate([[0], np.cumsum(self.active)])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        text = np.repeat(np.arange(len(lengths)), lengths)
        position = np.arange(len(text)) - starts[text]
        place = self.at[position] + text
        # order[place] = index among the concatenated texts
        self.order = np.empty(len(text), np.int64)
        self.order[place] = np.arange(len(text))
        self.text = text[self.order]

    def spans(self):
        return zip(self.at[:-1], self.at[1:])


def forward(layout: Layout, emitted, start, moves, out=None):
    """Scaled forward variables and scales; ``emitted`` holds each token's
    probability in each state. A text's likelihood is the product of its
    scales. ``out`` takes the variables; it may be ``emitted`` itself."""
    import numpy as np

    alpha, scale = np.empty_like(emitted) if out is None else out, np.empty(len(emitted), emitted.dtype)
    ones = np.ones(emitted.shape[1], emitted.dtype)
    now = None
    for a, b in layout.spans():
        part = alpha[a:b]
        if now is None:
            np.multiply(emitted[a:b], start, out=part)
        else:
            np.multiply(now[: b - a] @ moves, emitted[a:b], out=part)
        total = part @ ones
        part /= total[:, None]
        scale[a:b] = total
        now = part
    return alpha, scale


def expected(layout: Layout, emitted, start, moves):
    """Expected states of each token, and expected starts and moves."""
    import numpy as np

    alpha, scale = forward(layout, emitted, start, moves)
    emitted /= scale[:, None]
    back = np.ascontiguousarray(moves.T)
    gamma = np.empty_like(alpha)
    pairs = np.zeros_like(moves, dtype=np.float64)
    spans = list(layout.spans())
    a, b = spans[-1]
    beta = np.ones((b - a, alpha.shape[1]), alpha.dtype)
    gamma[a:b] = alpha[a:b]
    for (a, b), (c, d) in zip(spans[-2::-1], spans[:0:-1]):
        weighted = emitted[c:d] * beta
        pairs += alpha[a : a + (d - c)].T @ weighted
        beta = np.ones((b - a, alpha.shape[1]), alpha.dtype)
        np.matmul(weighted, back, out=beta[: d - c])
        np.multiply(alpha[a:b], beta, out=gamma[a:b])
    first = gamma[: layout.at[1]].sum(axis=0, dtype=np.float64)
    return gamma, first, pairs * moves


# --------------------------------------------------------------------------
# Baum-Welch steps
# --------------------------------------------------------------------------


@dataclass
class Parameters:
    """What a step starts from: all of bounded size."""

    start: object  # (states)
    moves: object  # (states, states)
    emit: object  # (tier + FORMS, states)


def first_parameters(symbols: int, states: int) -> Parameters:
    """Nearly even, told apart by seeded noise."""
    import numpy as np

    rng = np.random.default_rng(SEED)
    moves = np.full((states, states), 0.3 / states) + 0.7 * np.eye(states)
    return Parameters(np.full(states, 1 / states), moves, rng.gamma(2.0, 1.0, (symbols, states)).astype(np.float32))


def chunks(counts) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``CHUNK_TOKENS`` tokens; a longer text is one."""
    start, held = 0, 0
    for i, n in enumerate(counts):
        if held and held + n > CHUNK_TOKENS:
            yield start, i
            start, held = i, 0
        held += n
    if held:
        yield start, len(counts)


def coded(train: DataFrame, shared) -> DataFrame:
    """(symbols) of each text, four bytes a token: the word's place in the
    tier, or behind the tier its form."""

    def code(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tier = shared.value
        for batch in batches:
            for part in parts_of(batch):
                found, counts = words_of(part.column("text"))
                ids = places_in(found, tier)
                missing = np.flatnonzero(ids < 0)
                others = found.take(pa.array(missing)).dictionary_encode()
                own = np.array([len(tier) + form(word) for word in others.dictionary.to_pylist()], np.int64)
                ids[missing] = own[others.indices.to_numpy()]
                ids, ends = ids.astype("<i4"), np.cumsum(counts)
                rows = [ids[e - n : e].tobytes() for e, n in zip(ends, counts)]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["symbols"])

    return train.select("text").mapInArrow(code, "symbols binary")


def symbols_of(column):
    """The symbols of texts one after the other, and the number of each."""
    import numpy as np
    import pyarrow.compute as pc

    counts = pc.binary_length(column).to_numpy(zero_copy_only=False) // 4
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.int64), counts


def expectations(train: DataFrame, shared, parameters: Parameters, words: bool) -> DataFrame:
    """Sums of one Baum-Welch step in fixed point: (symbol, n, g0, g1, ...)
    from ``coded`` texts, or for ``words`` (symbol, word, n, g0, ...) from
    texts, one row per word."""
    states = len(parameters.start)
    column = "text" if words else "symbols"
    model = train.sparkSession.sparkContext.broadcast((parameters.start, parameters.moves, parameters.emit))
    names = [f"g{k}" for k in range(states)]

    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tier = shared.value if words else ()
        start, moves, emit = model.value
        start, moves = start.astype(np.float32), moves.astype(np.float32)
        rare: dict[bytes, int] = {}
        room = len(tier) + WORDS_HELD if words else len(emit)
        forms = np.arange(room)  # symbol of each id
        sums, seen = np.zeros((states, room)), np.zeros(room, np.int64)
        starts, moved = np.zeros(states), np.zeros((states, states))

        def grow(more: int) -> None:
            nonlocal forms, sums, seen
            if len(tier) + len(rare) + more > len(seen):
                extra = len(rare) + more
                forms = np.concatenate([forms, np.zeros(extra, np.int64)])
                sums = np.concatenate([sums, np.zeros((states, extra))], axis=1)
                seen = np.concatenate([seen, np.zeros(extra, np.int64)])

        def identify(found):
            """Ids of words: their place in the tier, or behind it a number of
            their own."""
            ids = places_in(found, tier)
            missing = np.flatnonzero(ids < 0)
            others = found.take(pa.array(missing)).dictionary_encode()
            grow(len(others.dictionary))
            own = []
            for word in others.dictionary.to_pylist():
                known = rare.get(word)
                if known is None:
                    known = rare[word] = len(tier) + len(rare)
                    forms[known] = len(tier) + form(word)
                own.append(known)
            ids[missing] = np.array(own, np.int64)[others.indices.to_numpy()]
            return ids

        def learn(texts: list):
            nonlocal starts, moved
            texts.sort(key=len, reverse=True)
            lengths = np.array([len(t) for t in texts])
            layout = Layout(lengths)
            ids = np.concatenate(texts)[layout.order]
            gamma, first, pairs = expected(layout, emit[forms[ids]], start, moves)
            for k in range(states):
                part = np.bincount(ids, weights=gamma[:, k])
                sums[k, : len(part)] += part
            part = np.bincount(ids)
            seen[: len(part)] += part
            starts += first
            moved += pairs

        def rows(begin: int = 0):
            """Sums of the ids from ``begin`` on, and of starts and moves."""
            at = begin + np.flatnonzero(seen[begin:])
            numbers = [np.concatenate([seen[at], np.zeros(1 + states, np.int64)])]
            for k in range(states):
                part = np.concatenate([sums[k, at], starts[k : k + 1], moved[:, k]])
                numbers.append(np.rint(part * UNIT).astype(np.int64))
            symbol = np.concatenate([forms[at], [_STARTS], _MOVES - np.arange(states)])
            columns = [pa.array(symbol, pa.int64())]
            if words:
                known = [None] * (len(tier) + len(rare))
                known[: len(tier)] = tier.to_pylist()
                for word, i in rare.items():
                    known[i] = word
                columns.append(pa.array([known[i] for i in at] + [None] * (1 + states), pa.binary()))
            columns += [pa.array(x, pa.int64()) for x in numbers]
            return pa.RecordBatch.from_arrays(columns, ["symbol", *(["word"] if words else []), "n", *names])

        for batch in batches:
            for part in parts_of(batch, column):
                found, counts = (words_of if words else symbols_of)(part.column(column))
                ends = np.cumsum(counts)
                # no more words at a time than the tables have room for
                for a, b in chunks(counts):
                    first, last = (ends[a - 1] if a else 0), ends[b - 1]
                    ids = identify(found.slice(first, last - first)) if words else found[first:last]
                    learn(np.split(ids, ends[a : b - 1] - first))
                    if words and len(rare) >= WORDS_HELD:
                        yield rows(len(tier))
                        rare.clear()
                        sums[:, len(tier) :], seen[len(tier) :], starts[:], moved[:] = 0, 0, 0, 0
        yield rows()

    keys = ["symbol", "word"] if words else ["symbol"]
    schema = ("symbol long, word binary, " if words else "symbol long, ") + ", ".join(f"{c} long" for c in ["n", *names])
    sums = train.select(column).mapInArrow(step, schema)
    return sums.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ["n", *names]])


def start_and_moves(special, share):
    """Start and move probabilities from the sums of a step, each smoothed by
    one count spread as the states are."""
    import numpy as np

    states = len(share)
    counts = np.zeros((1 + states, states))
    for symbol, row in special:
        counts[-1 - symbol] = row
    counts = counts / UNIT + share
    counts /= counts.sum(axis=1, keepdims=True)
    return counts[0], counts[1:]


def improved(sums: DataFrame, symbols: int, states: int) -> Parameters:
    """The parameters after a step; its sums have a row per symbol."""
    import numpy as np

    with released(sums.sparkSession):
        found = sums.toArrow()
    symbol = found.column("symbol").to_numpy()
    counts = np.stack([found.column(f"g{k}").to_numpy() for k in range(states)], axis=1).astype(np.float64)
    kept = symbol >= 0
    emit = np.zeros((symbols, states))
    emit[symbol[kept]] = counts[kept] / UNIT
    weight = emit.sum(axis=0)
    total = weight.sum()
    share = (weight + 1) / (total + states)
    start, moves = start_and_moves(zip(symbol[~kept], counts[~kept]), share)
    emit = (emit / share + 0.5) / (total + 0.5 * symbols)
    return Parameters(start, moves, emit.astype(np.float32))


# --------------------------------------------------------------------------
# The model
# --------------------------------------------------------------------------


@dataclass
class Model:
    """A fitted model. ``vocabulary`` is the table (word, f, p0, p1): counts
    and the packed shares of the states; everything else is of bounded size."""

    vocabulary: DataFrame
    level: int  # words of this level of count and above are broadcast
    start: object
    moves: object
    share: object  # share of all training tokens in each state
    n: int
    v: int


def packed(found: DataFrame, states: int) -> DataFrame:
    """(word, f, p0, p1): the shares of a word's states, 16 bits each, which
    add up to ``SHARES``; the last state has what the others leave."""
    total = " + ".join(f"g{k}" for k in range(states))
    shares = [f"CAST(floor(CAST(g{k} AS DOUBLE) * {SHARES} / nullif({total}, 0)) AS BIGINT)" for k in range(states - 1)]
    row = found.select("word", F.col("n").alias("f"), *[F.expr(f"coalesce({s}, 0L)").alias(f"s{k}") for k, s in enumerate(shares)])
    rest = " - ".join([f"{SHARES}L", *[f"s{k}" for k in range(states - 1)]])
    row = row.withColumn(f"s{states - 1}", F.expr(f"greatest({rest}, 0L)"))
    word = lambda ks: " | ".join(f"shiftleft(s{k}, {16 * (k % 4)})" for k in ks) or "0L"
    return row.select("word", "f", F.expr(word(range(min(4, states)))).alias("p0"), F.expr(word(range(4, states))).alias("p1"))


def share_sql(k: int) -> str:
    return f"(shiftrightunsigned(p{k // 4}, {16 * (k % 4)}) & {SHARES}L)"


def fit(docs: DataFrame, states: int = STATES, tier: int = TIER, steps: int = STEPS) -> Model:
    """Trains on all documents that are not held out."""
    import numpy as np
    import pyarrow as pa

    if not 1 <= states <= 8:
        raise ValueError("1 to 8 states")
    spark = docs.sparkSession
    train = docs.where(~held_out(F.col("doc_id"))).select(F.coalesce("text", F.lit("")).alias("text"))
    counted = materialize(word_counts(train), "hmm-words")
    totals = counted.agg(F.sum("f").alias("n"), F.count("*").alias("v")).first()
    level = tier_level(counted, tier)
    top = sorted(counted.where(F.expr(LEVEL) >= level).select("word").toArrow().column("word").to_pylist())
    shared = spark.sparkContext.broadcast(pa.array(top, pa.binary()))
    symbols = len(top) + FORMS
    parameters = first_parameters(symbols, states)
    texts = materialize(coded(train, shared), "hmm-symbols")
    for _ in range(steps - 1):
        parameters = improved(expectations(texts, shared, parameters, False), symbols, states)
    last = materialize(expectations(train, shared, parameters, True), "hmm-counts")
    names = [f"g{k}" for k in range(states)]
    special = [(r.symbol, [r[c] for c in names]) for r in last.where("symbol < 0").collect()]
    vocabulary = materialize(packed(last.where("symbol >= 0"), states), "hmm-vocabulary")
    sums = vocabulary.agg(*[F.expr(f"sum(CAST(f AS DECIMAL(19, 0)) * {share_sql(k)})").alias(f"s{k}") for k in range(states)]).first()
    n, v = totals.n or 0, totals.v or 0
    weight = np.array([float(x or 0) for x in sums])
    share = weight / (SHARES * n) if n else np.full(states, 1 / states)
    start, moves = start_and_moves(special, (weight / SHARES + 1) / (n + states))
    return Model(vocabulary, level, start, moves, share, n, v)


def unpacked(p0, p1, states: int):
    """Shares of the states, from arrays of packed ones."""
    import numpy as np

    words = [np.asarray(p, np.int64).view(np.uint64) for p in (p0, p1)]
    return np.stack([(words[k // 4] >> np.uint64(16 * (k % 4)) & np.uint64(SHARES)).astype(np.float64) for k in range(states)], axis=1)


class Scorer:
    """Probabilities of words in this process."""

    def __init__(self, start, moves, share, n: int, v: int):
        import numpy as np

        self.start, self.moves, self.n, self.v = start, moves, n, v
        # a state that emits nothing gives every word the probability of the unknown one
        self.scale = np.where(share > 0, 1 / np.where(share > 0, share, 1), 0)
        self.norm = n + 0.5 * (v + 1)

    def emission(self, f, p0, p1):
        counts = unpacked(p0, p1, len(self.start)) * (f / SHARES)[:, None]
        return (counts * self.scale + 0.5) / self.norm

    def base(self, f):
        import numpy as np

        return np.log10((f + 0.5) / self.norm)


class Outside:
    """The distinct words of each text outside the tier, as they come: slot
    i is word ``word[i]`` (an index of ``dictionary``), the ``j[i]``-th of text
    ``text[i]``; ``slot`` has the slot of each such token, ``at``."""

    def __init__(self, words, ids, counts):
        import numpy as np
        import pyarrow as pa

        self.at = np.flatnonzero(ids < 0)
        coded = words.take(pa.array(self.at)).dictionary_encode()
        self.dictionary = coded.dictionary
        text = np.repeat(np.arange(len(counts)), counts)[self.at]
        key = text * max(1, len(self.dictionary)) + coded.indices.to_numpy()
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        order = np.argsort(first)  # by text, then by first place
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.slot = rank[inverse]
        self.text = text[first[order]]
        self.word = coded.indices.to_numpy()[first[order]]
        self.start = np.searchsorted(self.text, np.arange(len(counts)))
        self.j = np.arange(len(order)) - self.start[self.text] if len(order) else order


def words_outside(docs: DataFrame, shared) -> DataFrame:
    """(text_key, j, word): the j-th distinct word of a text outside the tier."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        tier = shared.value[0]
        done: set[int] = set()
        for batch in batches:
            fresh = []
            for key in batch.column("text_key").to_pylist():
                fresh.append(key not in done)
                if len(done) >= SEEN_TEXTS:
                    done.clear()
                done.add(key)
            for part in parts_of(batch.filter(pa.array(fresh, pa.bool_()))):
                words, counts = words_of(part.column("text"))
                out = Outside(words, places_in(words, tier), counts)
                keys = part.column("text_key").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[out.text], pa.int64()),
                        pa.array(out.j.astype(np.int32), pa.int32()),
                        out.dictionary.take(pa.array(out.word)),
                    ],
                    ["text_key", "j", "word"],
                )

    return docs.select("text_key", "text").mapInArrow(run, "text_key long, j int, word binary")


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of every whole text."""
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    high = F.expr(LEVEL) >= model.level
    top = model.vocabulary.where(high).toArrow()
    columns = [top.column(c).to_numpy() for c in ("f", "p0", "p1")]
    tier = pa.array(top.column("word").to_pylist(), pa.binary())
    fixed = (model.start, model.moves, model.share, model.n, model.v)
    shared = spark.sparkContext.broadcast((tier, *[np.array(c) for c in columns]))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    more = (
        words_outside(rows, shared)
        .join(model.vocabulary.where(~high), "word")
        .groupBy("text_key")
        .agg(F.collect_set(F.struct("j", "f", "p0", "p1")).alias("more"))  # as long as a text at most
    )

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        scorer = Scorer(*fixed)
        tier, counts, p0, p1 = shared.value
        emit = scorer.emission(counts, p0, p1)

        def judge(words, lengths, more):
            """n_known, base and score of texts, given their words, the numbers
            of these, and the (j, f, p0, p1) of those outside the tier."""
            ids = places_in(words, tier)
            out = Outside(words, ids, lengths)
            many = pc.fill_null(pc.list_value_length(more), 0).to_numpy(zero_copy_only=False)
            flat = more.flatten()
            fields = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(4)]
            slot = out.start[np.repeat(np.arange(len(lengths)), many)] + fields[0]
            rare = np.zeros((3, len(out.text)), np.int64)
            for row, x in zip(rare, fields[1:]):
                row[slot] = x
            rare_emit = scorer.emission(*rare)
            by_length = np.argsort(-lengths, kind="stable")
            layout = Layout(lengths[by_length])
            sorted_lengths = lengths[by_length]
            shift = (np.cumsum(lengths) - lengths)[by_length] - (np.cumsum(sorted_lengths) - sorted_lengths)
            order = (np.repeat(shift, sorted_lengths) + np.arange(len(ids)))[layout.order]
            emitted = emit[np.maximum(ids, 0)] if len(tier) else np.empty((len(ids), rare_emit.shape[1]))
            emitted[out.at] = rare_emit[out.slot]
            f = counts[np.maximum(ids, 0)] if len(tier) else np.empty(len(ids), np.int64)
            f[out.at] = rare[0][out.slot]
            # one table of the tokens at a time, also for the forward variables
            emitted = emitted[order]
            _, scale = forward(layout, emitted, scorer.start, scorer.moves, out=emitted)
            found = np.empty(len(ids))
            found[order] = np.log10(scale)
            text = np.repeat(np.arange(len(lengths)), lengths)
            sums = [np.bincount(text, weights=x, minlength=len(lengths)) for x in (f > 0, scorer.base(f), found)]
            return sums[0].astype(np.int64), sums[1], sums[2]

        for batch in batches:
            for part in parts_of(batch):
                words, lengths = words_of(part.column("text"))
                ends = np.cumsum(lengths)
                for a, b in chunks(lengths):
                    first, last = (ends[a - 1] if a else 0), ends[b - 1]
                    some = part.slice(a, b - a)
                    known, base, total = judge(words.slice(first, last - first), lengths[a:b], some.column("more"))
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("doc_id"),
                            some.column("held_out"),
                            pa.array(lengths[a:b], pa.int64()),
                            pa.array(known, pa.int64()),
                            pa.array(np.full(b - a, scorer.n), pa.int64()),
                            pa.array(base, pa.float64()),
                            pa.array(total, pa.float64()),
                        ],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                    )

    joined = rows.join(more, "text_key", "left").select("doc_id", "held_out", "text", "more")
    return joined.mapInArrow(run, SCORES)
