"""Toxicity by compression distance.

Two zstandard dictionaries are trained by zstandard's trainer: the ordinary
one on windows of ordinary texts, the toxic one on what toxic texts say and
ordinary ones do not, namely the runs of their units (words, pairs of words,
and four-character pieces of scripts without spaces) whose document frequency
is significantly higher in toxic texts. A text is compressed in windows of
``WINDOW_WORDS`` words with the ordinary dictionary alone, and with the toxic
one behind it; both contents have the same length, so that ordinary text costs
the same. Where the toxic one gives shorter windows, the text says what toxic
texts say. The lengths saved are summed up per text, and a logistic
calibration fitted on labelled texts outside the dictionaries' part turns
them into a score from 0 to 1; 0.5 is the threshold.

The trainer sees at most about ``SAMPLE_BYTES`` of windows per dictionary,
chosen by hash; where these are too few for it, they are the dictionary.

The model is fitted on a bounded sample: about ``FIT_ROWS`` labelled rows
outside the held-out fold (crc32 of the id's text mod 5 is 0), chosen by hash
of the id; ``CALIBRATION_SHARE`` of them calibrate. Scores use the text alone.

Null and empty texts are one empty window. Rows labelled twice are toxic if
any label says so; null labels are ignored. Without labels of both classes
the score is the share of toxic labels (0 without any). Repeated rows are
scored alike; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playmart.llm import common

FIT_ROWS = 30_000
CALIBRATION_SHARE = 0.25
WINDOW_WORDS = 16
# Sizes of the trained dictionaries, and of what they are trained on.
ORDINARY_BYTES = 112_640
TOXIC_BYTES = 2_048
SAMPLE_BYTES = 8 << 20
# Words, or runs of toxic units, per training window; the trainer's segments
# and the strings it looks for, in bytes.
SAMPLE_WORDS = 4
SEGMENT, STRING = 16, 6
TOXIC_UNITS = 4_000
LONGEST_WORD = 40
PIECE = 4
# Least log-likelihood ratio of a toxic unit's document counts.
LEAST_EVIDENCE = 16.0
UNITS_HELD = 1_000_000
# Never in UTF-8: evens out the lengths of the dictionaries.
FILLER = b"\xff"
# Follows each window, as zstandard does not look for matches in the last eight
# bytes; words hold no line feeds.
TAIL = b"\n" * 8

SCORES = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class Model:
    """Dictionaries and calibration; picklable and of bounded size."""

    ordinary: bytes = b" "
    toxic: bytes = b" "
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    base: float = 0.0

    @property
    def name(self) -> str:
        return hashlib.md5(self.ordinary + b"\0" + self.toxic + repr((self.weights, self.base)).encode()).hexdigest()


def compressor(content: bytes):
    """Small-window compressor that starts from dictionary content, with
    tables that have room for every byte of it."""
    import zstandard as zs

    size = max(10, len(content).bit_length())
    params = zs.ZstdCompressionParameters(
        format=zs.FORMAT_ZSTD1_MAGICLESS,
        window_log=max(19, size),
        hash_log=size,
        chain_log=size,
        search_log=6,
        min_match=4,
        target_length=32,
        strategy=zs.STRATEGY_LAZY,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    words = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    return zs.ZstdCompressor(dict_data=words, compression_params=params)


class Scorer:
    """Compression lengths of texts in this process."""

    def __init__(self, model: Model):
        self.model = model
        self.ordinary, self.toxic = compressor(model.ordinary), compressor(model.toxic)

    def saved(self, text: str) -> list[int]:
        """Bytes that the toxic dictionary saves in each window."""
        words = text.lower().split()
        a, b, k = self.ordinary.compress, self.toxic.compress, WINDOW_WORDS
        out = []
        for i in range(0, len(words) or 1, k):
            window = f" {' '.join(words[i : i + k])} ".encode("utf-8", "replace") + TAIL
            out.append(len(a(window)) - len(b(window)))
        return out

    def features(self, text: str) -> list[float]:
        import numpy as np

        m = np.sort(np.array(self.saved(text), float))
        n = len(m)
        return [
            float(m[-1]),
            float(m[-3:].mean()),
            float(m.mean()),
            float(np.log1p(np.maximum(m - 2, 0).sum())),
            float(np.log1p(n)),
            float((m >= 3).mean()),
            float((m >= 5).mean()),
            float(np.sqrt((m >= 3).sum())),
        ]

    def score(self, text: str) -> float:
        import math

        model = self.model
        if not model.weights:
            return model.base
        z = model.weights[0]
        for x, mean, scale, w in zip(self.features(text), model.mean, model.scale, model.weights[1:]):
            z += w * (x - mean) / scale
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic, calibrates) of about ``rows`` labelled documents outside
    the held-out fold; the ids are few enough to broadcast, by the bound."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    n = known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 32))
    sample = known.where(place < int((1 << 32) * min(1.0, rows / max(n, 1))))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1000)) < int(1000 * CALIBRATION_SHARE)
    sample = sample.select(F.col("doc_id").alias("label_id"), "toxic", part.alias("calibrates"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    return common.materialize(found.select("text", "toxic", "calibrates"), "toxicity-sample")


def places_of_units(text: str) -> tuple[str, list[tuple[int, int]]]:
    """A text in lower case with single spaces, and where its units stand in
    it: words, pairs of words, and pieces of words too long to be ones."""
    words = text.lower().split()
    places, at, last = [], 1, None
    for w in words:
        end = at + len(w)
        if len(w) <= LONGEST_WORD:
            places.append((at, end))
            if last is not None:
                places.append((last, end))
            last = at
        else:
            places += [(i, i + PIECE) for i in range(at, end - PIECE + 1)]
            last = None
        at = end + 1
    return f" {' '.join(words)} ", places


def unit_counts(train: DataFrame) -> DataFrame:
    """(unit, t, o): toxic and ordinary texts that hold each unit."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        found: tuple[Counter, Counter] = (Counter(), Counter())

        def rows():
            units = list(found[0].keys() | found[1].keys())
            columns = [pa.array(units, pa.string()), *[pa.array([c[u] for u in units], pa.int64()) for c in (found[1], found[0])]]
            return pa.RecordBatch.from_arrays(columns, ["unit", "t", "o"])

        for batch in batches:
            for toxic, text in zip(batch.column("toxic").to_pylist(), common.texts(batch.column("text"))):
                whole, places = places_of_units(text)
                found[toxic].update({whole[a:b] for a, b in places})
                if len(found[0]) + len(found[1]) >= UNITS_HELD:
                    yield rows()
                    found = (Counter(), Counter())
        yield rows()

    counts = train.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(run, "unit string, t long, o long")
    return counts.groupBy("unit").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def toxic_units(train: DataFrame, toxic: float, ordinary: float) -> list[str]:
    """The units with the strongest evidence, by the log-likelihood ratio of
    their document counts in the two classes."""
    expected = f"((t + o) * {toxic} / {toxic + ordinary})"
    part = lambda x, e: f"(CASE WHEN {x} > 0 THEN {x} * ln({x} / {e}) ELSE 0D END)"
    others = f"((t + o) * {ordinary} / {toxic + ordinary})"
    units = unit_counts(train).where(f"t > {expected} * 3")
    units = units.withColumn("evidence", F.expr(f"2 * ({part('t', expected)} + {part('o', others)})"))
    told = units.where(F.col("evidence") >= LEAST_EVIDENCE).orderBy(F.desc("evidence"), "unit").limit(TOXIC_UNITS)
    return sorted(r.unit for r in told.select("unit").collect())


def runs_of(text: str, units: set[str]) -> list[str]:
    """The parts of a text that toxic units cover, a space on either side of
    those at the border of a word."""
    whole, places = places_of_units(text)
    runs: list[list[int]] = []
    for a, b in sorted(p for p in places if whole[p[0] : p[1]] in units):
        a, b = a - (whole[a - 1] == " "), b + (whole[b] == " ")
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return [whole[a:b] for a, b in runs]


def training_windows(train: DataFrame, units: list[str] | None) -> list[bytes]:
    """What a dictionary is trained on: windows of ordinary texts, or with
    ``units`` runs of these in toxic texts. At most about ``SAMPLE_BYTES``,
    chosen by hash of the text and the place, in an order of their own."""
    known = None if units is None else set(units)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for text in common.texts(batch.column("text")):
                if known is None:
                    words = text.lower().split()
                    parts = [f" {' '.join(words[i : i + SAMPLE_WORDS])} " for i in range(0, len(words), SAMPLE_WORDS)]
                else:
                    runs = runs_of(text, known)
                    parts = ["".join(runs[i : i + SAMPLE_WORDS]) for i in range(0, len(runs), SAMPLE_WORDS)]
                mark = hashlib.md5(text.encode("utf-8", "replace")).hexdigest()
                out += [(f"{mark}-{i}", p.encode("utf-8", "replace")) for i, p in enumerate(parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], ["place", "window"]
            )

    rows = train.where(F.col("toxic") == int(known is not None)).select("text").mapInArrow(run, "place string, window binary")
    rows = common.materialize(rows, "toxicity-windows")
    size = rows.agg(F.sum(F.octet_length("window"))).first()[0] or 0
    limit = int((1 << 32) * min(1.0, SAMPLE_BYTES / max(1, size)))
    some = rows.where(F.pmod(F.xxhash64("place"), F.lit(1 << 32)) < limit).toArrow()
    pairs = zip(some.column("place").to_pylist(), some.column("window").to_pylist())
    return [w for _, w in sorted(pairs, key=lambda p: (hashlib.md5(p[0].encode()).digest(), p))]


def trained(windows: list[bytes], size: int) -> bytes:
    """A dictionary of zstandard's trainer; the windows themselves where they
    are too few for it."""
    import zstandard as zs

    if sum(map(len, windows)) > 2 * size:
        try:
            return zs.train_dictionary(size, windows, k=SEGMENT, d=STRING).as_bytes()
        except zs.ZstdError:
            pass
    return b"".join(dict.fromkeys(windows))[-size:]


def dictionaries(sample: DataFrame) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary."""
    train = sample.where("not calibrates")
    sizes = train.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    toxic, ordinary = float(sizes.t or 0), float(sizes.n - (sizes.t or 0))
    if not toxic or not ordinary:
        return b" ", b" "
    told = trained(training_windows(train, toxic_units(train, toxic, ordinary)), TOXIC_BYTES)
    plain = trained(training_windows(train, None), ORDINARY_BYTES)
    # the toxic part last, where matches are cheapest
    return plain + FILLER * len(told), plain + told


def scored(rows: DataFrame, shared, schema: str, columns: list[str], make) -> DataFrame:
    """``columns`` of ``rows`` and what ``make(scorer, texts)`` adds."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value
        scorer = common.worker_state(f"toxicity:{model.name}", lambda: Scorer(model))
        for batch in batches:
            added = make(scorer, common.texts(batch.column("text")))
            arrays = [batch.column(c) for c in columns] + [pa.array(v, kind) for _, v, kind in added]
            yield pa.RecordBatch.from_arrays(arrays, columns + [n for n, _, _ in added])

    return rows.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Dictionaries and calibration from a bounded sample of labelled rows."""
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, rows)
    sizes = sample.agg(F.avg("toxic").alias("base")).first()
    ordinary, toxic = dictionaries(sample)
    model = Model(ordinary, toxic, base=float(sizes.base or 0.0))
    kind = pa.list_(pa.float64())
    shared = spark.sparkContext.broadcast(model)
    found = scored(
        sample.where("calibrates").select("toxic", "text"),
        shared,
        "toxic int, x array<double>",
        ["toxic"],
        lambda s, texts: [("x", [s.features(t) for t in texts], kind)],
    ).collect()
    y = np.array([r.toxic for r in found], float)
    if len(set(y)) < 2:
        return model
    x = np.array([r.x for r in found])
    # sorted rows: the fit does not depend on the order they arrived in
    order = np.lexsort(np.c_[x, y].T)
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w, ridge = np.zeros(z.shape[1]), 1e-3 * len(y)
    penalty = ridge * np.r_[0.0, np.ones(z.shape[1] - 1)]
    for _ in range(50):  # Newton steps of a ridge-penalized logistic regression
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (p - y) + penalty * w
        bend = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-6)
        step = np.linalg.solve(bend, slope)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    model.mean, model.scale, model.weights = mean.tolist(), scale.tolist(), w.tolist()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text")

    def add(scorer: Scorer, texts: list[str]):
        found = [scorer.score(t) for t in texts]
        return [("score", found, pa.float64()), ("predicted", [int(s >= 0.5) for s in found], pa.int32())]

    return scored(rows, shared, SCORES, ["doc_id", "held_out"], add)


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents not predicted toxic, whole rows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        fitted = shared.value
        scorer = common.worker_state(f"toxicity:{fitted.name}", lambda: Scorer(fitted))
        for batch in batches:
            fine = [scorer.score(t) < 0.5 for t in common.texts(batch.column("text"))]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
