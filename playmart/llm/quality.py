"""Quality rules with robust multivariate outliers, in DataFrame functions only.

``text_statistics`` counts, per whole text, words, their characters, symbol
characters, repeated lines and words in repeated five-word windows. Documents
that fail a fixed base rule are rejected. Of the others, each (language,
source) group gets a minimum-covariance-determinant estimate of the
transformed statistics: from the medians and median deviations, concentration
steps keep the ``CORE`` share of documents nearest by Mahalanobis distance
and re-estimate mean and covariance from them. A document whose distance to
its group's estimate passes ``CUTOFF`` is rejected. A group with fewer than
``MIN_GROUP`` documents is judged by the estimate of its language, computed in
the same way from all documents of the language, and a language with fewer by
that of all documents.

Statistics enter as logarithms rounded to 1/``GRID``; medians and the core's
quantile are exact over these bounded grids and moments are exact decimal
sums, so verdicts do not depend on the order of rows. ``FLOORS`` keeps a
statistic that hardly varies in a group from rejecting small deviations.

Defined cases: null or empty text has no words and fails the base rule; null
language or source is a group of its own; with fewer than ``MIN_GROUP``
documents in all nothing is rejected by distance; repeated rows are judged
alike; extra columns are ignored; an empty table gives an empty table.
Windows and words are compared by 64-bit hashes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.llm.common import materialize

WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

GRID = 256
CORE = 0.75
STEPS = 3
MIN_GROUP = 50
# Fixed value: consistency factor of a 75 % core in five dimensions,
# 0.75 / P(chi2_7 <= q) with q the 75 % quantile of chi2_5.
CONSISTENCY = 1.41
# Squared distance beyond which a document is an outlier; the 1 - 1e-8
# quantile of chi2_5 is 47.
CUTOFF = 50.0

# name -> (transformed statistic, least standard deviation it is given)
STATISTICS = {
    "words": ("ln(1.0D + n_words)", 0.5),
    "length": ("ln(1.0D + word_chars / n_words)", 0.08),
    "symbols": ("ln(1.0D + 1000.0D * n_symbols / word_chars)", 0.5),
    "lines": ("ln(1.0D + 100.0D * n_dup_lines / n_words)", 0.5),
    "repeats": ("ln(1.0D + 100.0D * n_repeat_words / n_words)", 0.5),
}
# What an estimate is of: 0 a group, 1 a language (source null), 2 all documents.
LEVELS = ["struct(0 AS level, lang, source)", "struct(1 AS level, lang, NULL AS source)", "struct(2 AS level, NULL AS lang, NULL AS source)"]
KEY = ["level", "lang", "source"]
NAMES = list(STATISTICS)
P = len(NAMES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def repeated_words_sql(words: str) -> str:
    """Words covered by five-word windows that occur more than once."""
    window = ", ".join(f"get(h, i + {k})" for k in range(WINDOW))
    windows = (
        f"CASE WHEN size(h) < {WINDOW} THEN cast(array() AS array<bigint>) "
        f"ELSE transform(sequence(0, size(h) - {WINDOW}), i -> xxhash64({window})) END"
    )
    # starts of windows that equal a neighbour in sorted order
    starts = let(
        "sort_array(transform(g, (x, i) -> struct(x AS x, i AS i)))",
        "s",
        "sort_array(transform(filter(s, (e, i) -> coalesce(get(s, i - 1).x = e.x, false) "
        "OR coalesce(get(s, i + 1).x = e.x, false)), e -> e.i))",
    )
    covered = let(
        starts,
        "p",
        f"aggregate(transform(p, (x, i) -> least({WINDOW}, coalesce(get(p, i + 1) - x, {WINDOW}))), 0, (a, x) -> a + x)",
    )
    return let(
        f"transform({words}, w -> xxhash64(w))",
        "h",
        let(windows, "g", f"CASE WHEN size(array_distinct(g)) = size(g) THEN 0 ELSE {covered} END"),
    )


def statistics_sql(text: str = "text") -> str:
    """SQL of a struct with the ``COUNTS`` of a text column."""
    lines = f"filter(split({text}, '\\n'), l -> l rlike '{WORD}')"
    dup = let(lines, "ls", "size(ls) - size(array_distinct(ls))")
    body = let(
        "array_join(ws, '')",
        "j",
        f"struct(cast(size(ws) AS bigint) AS n_words, cast(char_length(j) AS bigint) AS word_chars, "
        f"cast(char_length(j) - char_length(regexp_replace(j, '{SYMBOLS}', '')) AS bigint) AS n_symbols, "
        f"cast({dup} AS bigint) AS n_dup_lines, cast({repeated_words_sql('ws')} AS bigint) AS n_repeat_words)",
    )
    return let(f"regexp_extract_all({text}, '{WORD}', 0)", "ws", body)


def text_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``q_counts`` and ``q_failed`` (the base rule)."""
    # the generator keeps the counts from being computed again in each use
    counted = docs.withColumn("q_counts", F.explode(F.array(F.expr(statistics_sql("coalesce(text, '')")))))
    c = F.col("q_counts")
    return counted.withColumn(
        "q_failed", (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
    )


def transformed(stats: DataFrame) -> DataFrame:
    """Flat statistics with the rounded logarithms ``x_<name>``."""
    return stats.select(
        "*",
        *[
            F.expr(f"CASE WHEN n_words > 0 THEN cast(round({GRID} * {sql}) AS bigint) ELSE 0 END").alias(f"x_{n}")
            for n, (sql, _) in STATISTICS.items()
        ],
    )


def with_factor(moments: DataFrame, scale: float) -> DataFrame:
    """Cholesky factor ``l_i_j`` of each group's covariance ``c_i_j`` times
    ``scale``, with the floors added to its diagonal."""
    out = moments
    floors = [f * f for _, f in STATISTICS.values()]
    for i, j in PAIRS:  # row by row: every entry needs earlier ones only
        value = scale * F.col(f"c_{i}_{j}")
        if i == j:
            value = value + F.lit(floors[i])
        for k in range(j):
            value = value - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        value = F.sqrt(F.greatest(value, F.lit(floors[i] / 4))) if i == j else value / F.col(f"l_{j}_{j}")
        out = out.withColumn(f"l_{i}_{j}", value)
    return out.select(*KEY, "n", *[f"m_{i}" for i in range(P)], *[f"l_{i}_{j}" for i, j in PAIRS])


def with_levels(rows: DataFrame) -> DataFrame:
    """``rows`` once for each level, with the key of the estimate there."""
    others = [c for c in rows.columns if c not in KEY]
    return rows.select(*others, F.explode(F.expr(f"array({', '.join(LEVELS)})")).alias("k")).select(*others, "k.*")


def same_group(names: list[str] = KEY):
    """Join condition with a table of groups whose key is ``g_...``."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in names])


def distances(out: DataFrame) -> DataFrame:
    """``d2`` of rows that carry the mean ``m_i`` and the factor ``l_i_j``."""
    for i, name in enumerate(NAMES):  # forward substitution
        value = F.col(f"x_{name}") / F.lit(float(GRID)) - F.col(f"m_{i}")
        for k in range(i):
            value = value - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        out = out.withColumn(f"y_{i}", value / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, P)), F.col("y_0") * F.col("y_0"))
    return out.withColumn("d2", d2)


def with_distance(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2`` to the estimate of the row's group
    and level; null where there is none."""
    g = groups.withColumnsRenamed({c: f"g_{c}" for c in KEY})
    return distances(rows.join(g, same_group(), "left")).select(*rows.columns, "d2")


def with_verdict(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``d2`` by the finest level that has an estimate; null without any."""
    g = groups.withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    names = [c for c in groups.columns if c not in KEY]
    found, finest = rows, []
    for level, key in enumerate([["lang", "source"], ["lang"], []]):
        own = g.where(F.col("level") == level).select(*[f"g_{c}" for c in key], F.struct(*names).alias(f"e_{level}"))
        found = found.join(own if key else F.broadcast(own), same_group(key) if key else F.lit(True), "left")
        found = found.drop(*[f"g_{c}" for c in key])
        finest.append(F.col(f"e_{level}"))
    found = found.select(*rows.columns, F.coalesce(*finest).alias("e")).select(*rows.columns, *[F.col("e")[c].alias(c) for c in names])
    return distances(found).select(*rows.columns, "d2")


def moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance of each group from exact sums."""
    x = [F.col(f"x_{n}") for n in NAMES]
    sums = rows.groupBy(*KEY).agg(
        F.count("*").alias("n"),
        *[F.sum(x[i].cast("decimal(18,0)")).alias(f"s_{i}") for i in range(P)],
        *[F.sum((x[i] * x[j]).cast("decimal(18,0)")).alias(f"p_{i}_{j}") for i, j in PAIRS],
    )
    n = F.col("n").cast("double")
    mean = [F.col(f"s_{i}").cast("double") / n / GRID for i in range(P)]
    return sums.select(
        *KEY,
        "n",
        *[mean[i].alias(f"m_{i}") for i in range(P)],
        *[
            (F.col(f"p_{i}_{j}").cast("double") / n / (GRID * GRID) - mean[i] * mean[j]).alias(f"c_{i}_{j}")
            for i, j in PAIRS
        ],
    )


def first_estimate(rows: DataFrame) -> DataFrame:
    """Diagonal start: medians and median absolute deviations."""
    centre = rows.groupBy(*KEY).agg(
        F.count("*").alias("n"), *[F.expr(f"percentile(x_{n}, 0.5)").alias(f"v_{i}") for i, n in enumerate(NAMES)]
    )
    centre = materialize(centre.where(F.col("n") >= MIN_GROUP), "quality-centre")
    near = rows.join(centre.withColumnsRenamed({c: f"g_{c}" for c in KEY}), same_group())
    spread = near.groupBy(*KEY).agg(
        F.first("n").alias("n"),
        *[F.first(f"v_{i}").alias(f"v_{i}") for i in range(P)],
        *[F.expr(f"percentile(abs(x_{n} - v_{i}), 0.5)").alias(f"d_{i}") for i, n in enumerate(NAMES)],
    )
    # 1.4826: the median absolute deviation of a normal variable in standard deviations
    var = lambda i: (F.col(f"d_{i}") * 1.4826 / GRID) * (F.col(f"d_{i}") * 1.4826 / GRID)
    return spread.select(
        *KEY,
        "n",
        *[(F.col(f"v_{i}") / GRID).alias(f"m_{i}") for i in range(P)],
        *[(var(i) if i == j else F.lit(0.0)).alias(f"c_{i}_{j}") for i, j in PAIRS],
    )


def group_estimates(rows: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimate of each group, language and
    all documents with at least ``MIN_GROUP`` that pass the base rule. One small table per
    concentration step is written to the shared folder."""
    good = with_levels(rows.where(~F.col("failed")))
    groups = materialize(with_factor(first_estimate(good), 1.0), "quality-groups")
    for _ in range(STEPS):
        near = with_distance(good, groups).where("d2 is not null")
        # distances on a bounded logarithmic grid, so the quantile is exact in bounded state
        near = near.withColumn("dq", F.expr(f"cast(floor({GRID} * ln(1 + d2)) AS int)"))
        core = near.groupBy(*KEY).agg(F.expr(f"percentile(dq, {CORE})").alias("core"))
        core = materialize(core, "quality-core").withColumnsRenamed({c: f"g_{c}" for c in KEY})
        kept = near.join(core, same_group()).where("dq <= core")
        groups = materialize(with_factor(moments(kept), CONSISTENCY), "quality-groups")
    return groups


def flat(counted: DataFrame) -> DataFrame:
    """The statistics of ``text_statistics`` rows without their texts."""
    return transformed(
        counted.select(
            F.col("doc_id").cast("long"), "lang", "source", *[f"q_counts.{c}" for c in COUNTS], F.col("q_failed").alias("failed")
        )
    )


def judge(docs: DataFrame) -> DataFrame:
    """Counts and verdicts, one row per document."""
    rows = materialize(flat(text_statistics(docs)), "quality-statistics")
    judged = with_verdict(rows, group_estimates(rows))
    return judged.select(
        "doc_id",
        *COUNTS,
        F.col("failed").alias("base_failed"),
        (~F.col("failed") & (F.coalesce("d2", F.lit(0.0)) <= CUTOFF)).alias("kept"),
        "d2",
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents that are kept, whole rows. Texts stay where they are
    read: statistics are computed twice instead of shuffling the texts."""
    names = docs.columns
    rows = materialize(flat(text_statistics(docs)), "quality-statistics")
    groups = group_estimates(rows)
    again = text_statistics(docs.select(F.struct(*names).alias("row"), "text", "lang", "source"))
    again = transformed(again.where(~F.col("q_failed")).select("row", "lang", "source", *[f"q_counts.{c}" for c in COUNTS]))
    judged = with_verdict(again, groups)
    return judged.where(F.coalesce("d2", F.lit(0.0)) <= CUTOFF).select("row.*")
