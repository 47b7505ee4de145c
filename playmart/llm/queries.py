"""Registered queries of the training-data operators and their oracle SQL.

Each query applies one operator to its whole table with production
parameters and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playmart.llm import (
    bpe,
    collocations,
    hidden_markov,
    line_dedup,
    lsh,
    ngram_join,
    packing,
    quality,
    reversed_search,
    token_counts,
    toxicity,
    url_filter,
    warc,
)
from playmart.llm.common import materialize, table
from playmart.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

# Token limit of one training sequence for ``over_limit`` in op9.
OVER_LIMIT = 1024
# Id that ends every document in the packed sequences of op3.
PACK_END_ID = 2


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_multiprobe_lsh(spark: SparkSession, sf: str) -> DataFrame:
    return lsh.search(table(spark, sf, "embeddings"), k=20, every=20)


def op2_compression_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))


def op3_cost_balanced_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), PACK_END_ID)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_url_automaton(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"))


def op5_robust_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge(table(spark, sf, "documents")).drop("d2")


def op6_partenum_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf, "documents"), size=3, num=90, den=100)


def op7_forced_boundary_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_fuzzy_lines(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.removed_lines(table(spark, sf, "documents"))


def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)


def op10_warc_transactions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), path, revisit_from=0)
    # the records without payloads are small; they are read several times
    records = materialize(warc.read_archives(spark, path, payload=False), "warc-records")
    rows = warc.assemble(records).select(
        "capture_id",
        F.expr("try_cast(element_at(metadata[0].fields, 'page-id') AS BIGINT)").alias("page_id"),
        "capture.record_type",
        F.col("capture.refers_to").alias("head_id"),
        "capture.payload_digest",
        "capture.payload_bytes",
    )
    heads = rows.where("record_type = 'response'").select(
        F.col("capture_id").alias("head_id"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("head_bytes"),
    )
    # only revisits look for their response; the others have no key to meet on
    revisits = rows.where("head_id is not null").join(heads, "head_id", "left")
    others = rows.where("head_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    return revisits.withColumn("payload_bytes", F.col("head_bytes")).unionByName(others, allowMissingColumns=True).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_hidden_markov(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return hidden_markov.score(docs, hidden_markov.fit(docs))


def op12_reversed_search(spark: SparkSession, sf: str) -> DataFrame:
    return reversed_search.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_quotient_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    "op1_multiprobe_lsh": op1_multiprobe_lsh,
    "op2_compression_toxicity": op2_compression_toxicity,
    "op3_cost_balanced_packing": op3_cost_balanced_packing,
    "op4_url_automaton": op4_url_automaton,
    "op5_robust_outliers": op5_robust_outliers,
    "op6_partenum_join": op6_partenum_join,
    "op7_forced_boundary_bpe": op7_forced_boundary_bpe,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_token_counts": op9_token_counts,
    "op10_warc_transactions": op10_warc_transactions,
    "op11_hidden_markov": op11_hidden_markov,
    "op12_reversed_search": op12_reversed_search,
    "op13_quotient_collocations": op13_quotient_collocations,
}


def _op4_sql() -> str:
    ranked = sorted(url_filter.SITE_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [
        f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ranked
    ]
    rule = " ".join(f"WHEN {fit} THEN '{h}{p}'" for fit, (_, h, p) in zip(fits, ranked))
    verdict = " ".join(f"WHEN {fit} THEN '{v}'" for fit, (v, _, _) in zip(fits, ranked))
    spam = " OR ".join(
        f"contains({'host || path' if g.startswith('**') else 'host'}, '{g.strip('*').removesuffix('*/')}')"
        + (" AND contains(path, '/')" if g.endswith("/**") and not g.startswith("**") else "")
        for g in url_filter.BLOCK_GLOBS
    )
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), parts AS (
  SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM split
)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN {spam} THEN 'block' ELSE 'allow' END AS verdict
FROM parts"""


LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERMS = "regexp_extract_all(" + LOWERED.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
total AS (SELECT count(*) AS n_docs, sum(len(words)) AS n_terms FROM doc WHERE len(words) > 0),
tf AS (SELECT r, any_value(doc_id) AS doc_id, any_value(len(words)) AS n, term, count(*) AS tf
  FROM (SELECT r, doc_id, words, unnest(words) AS term FROM doc) GROUP BY r, term),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, total GROUP BY term, n_docs),
item AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scored AS (SELECT item_id, r, any_value(doc_id) AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term), total GROUP BY item_id, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10"""

OP13_SQL = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({LOWERED.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
word AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM word GROUP BY lang),
gram AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS p
  FROM word CROSS JOIN (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE len(w) >= m),
f AS (SELECT lang, p, any_value(m) AS m, count(*) AS f FROM gram GROUP BY lang, p HAVING count(*) >= 30),
cand AS (SELECT lang, p, m, f AS a, string_split(p, ' ') AS w FROM f WHERE m >= 2),
part AS (SELECT lang, p, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
  FROM cand CROSS JOIN (VALUES (1), (2), (3)) AS cuts(k) WHERE k < m),
cut AS (SELECT part.lang, part.p, a, k, x.f AS l, y.f AS r, CAST(2000000 * a::HUGEINT // (x.f + y.f) AS BIGINT) AS score
  FROM part JOIN f x ON x.lang = part.lang AND x.p = head JOIN f y ON y.lang = part.lang AND y.p = tail),
weakest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT lang, a, unnest(list_transform(range(1, m - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS p
  FROM cand CROSS JOIN (VALUES (2), (3)) AS inner_sizes(s) WHERE s < m),
cover AS (SELECT lang, p, max(a) AS cover FROM inside GROUP BY lang, p),
kept AS (SELECT q.* FROM weakest q LEFT JOIN cover c ON c.lang = q.lang AND c.p = q.p
  WHERE cover IS NULL OR 100 * cover < 80 * q.a),
ranked AS (SELECT lang, a, l, r, score, p AS phrase,
  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""

ORACLE: dict[str, str] = {
    "op4_url_automaton": _op4_sql(),
    "op12_reversed_search": OP12_SQL,
    "op13_quotient_collocations": OP13_SQL,
}
