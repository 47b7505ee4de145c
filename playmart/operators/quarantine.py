"""Quarantine of landed documents (F4, Q12): every document that a rule of the
ingest drops or defaults is kept, with its source, key, rule and body, next
to the counts of the ingest report, so that it can be repaired and replayed.

One job writes the quarantine, in folders by source and rule, and observes
the counts on the way: each document is parsed once for both. A dropped game
of the review pages has a row without a body; the pages that made it drop
have rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playmart.functions.sqltext import literal
from playmart.operators import ingest

ROWS = "game_id BIGINT, language STRING, body STRING, source STRING, rule STRING"
# Rules that drop or default something; a game coming soon is no fault.
RULES = {
    "app_details": [m for m in ingest.DETAILS_METRICS if m != "coming_soon"],
    "player_counts": ["not_json", "no_count"],
    "review_pages": ["not_json", "games_dropped"],
}


def _broken(rules: DataFrame, source: str, language: str = "CAST(NULL AS STRING)") -> DataFrame:
    """A row per document and rule that it breaks."""
    names = ", ".join(f"CASE WHEN {r} THEN {literal(r)} END" for r in RULES[source])
    return rules.selectExpr(
        "game_id", f"{language} AS language", "body", f"{literal(source)} AS source", f"explode(array_compact(array({names}))) AS rule"
    )


def _observed(rows: DataFrame, metrics: list[str]) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("documents"), *[F.count_if(m).alias(m) for m in metrics]), seen


def write(details_docs: DataFrame, count_docs: DataFrame, parsed_pages: DataFrame, path: str) -> dict[str, int]:
    """Writes the quarantine and returns the metrics of the ingest report.
    ``parsed_pages`` are those of ``ingest.parse_review_pages``, staged."""
    details, of_details = _observed(ingest.details_rules(details_docs), ingest.DETAILS_METRICS)
    counts, of_counts = _observed(ingest.player_count_rules(count_docs), RULES["player_counts"])
    pages = parsed_pages.selectExpr("game_id", "language", "bad_body AS body", "NOT valid AS not_json", "false AS games_dropped")
    usable = ingest.usable_games(parsed_pages.select("game_id", "language", "valid")).withColumn("ok", F.lit(True))
    games = parsed_pages.select("game_id").distinct().join(usable, "game_id", "left").selectExpr(
        "game_id", "CAST(NULL AS STRING) AS body", "false AS not_json", "ok IS NULL AS games_dropped"
    )
    games, of_games = _observed(games, ["games_dropped"])
    pages, of_pages = _observed(pages, ["not_json"])
    rows = (
        _broken(details, "app_details")
        .unionByName(_broken(counts, "player_counts"))
        .unionByName(_broken(pages, "review_pages", "language"))
        .unionByName(_broken(games, "review_pages"))
    )
    rows.write.mode("overwrite").partitionBy("source", "rule").parquet(path)
    found = {f"app_details.{m}": of_details.get[m] for m in ["documents", *ingest.DETAILS_METRICS]}
    found |= {f"player_counts.{m}": of_counts.get[m] for m in ["documents", *RULES["player_counts"]]}
    return found | {
        "review_pages.games": of_games.get["documents"],
        "review_pages.not_json": of_pages.get["not_json"],
        "review_pages.games_dropped": of_games.get["games_dropped"],
    }


def read(spark: SparkSession, path: str) -> DataFrame:
    """(game_id, language, body, source, rule) of the quarantined documents."""
    return spark.read.schema(ROWS).parquet(path)


def replay(quarantined: DataFrame, repaired: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Repaired bodies (game_id, body) of quarantined documents of a source,
    parsed by the ingest's rules, and what stays in quarantine. A repaired
    body that still breaks a rule stays, with its new rule and body."""
    parse = {"app_details": ingest.parse_app_details, "player_counts": ingest.parse_player_counts}[source]
    rules = {"app_details": ingest.details_rules, "player_counts": ingest.player_count_rules}[source]
    own = quarantined.filter(F.col("source") == source)
    known = repaired.select("game_id", "body").join(own.select("game_id").distinct(), "game_id", "left_semi")
    still = _broken(rules(known), source)
    fine = known.join(still.select("game_id").distinct(), "game_id", "left_anti")
    stays = quarantined.join(
        known.select("game_id", F.lit(source).alias("source")).distinct(), ["game_id", "source"], "left_anti"
    )
    return parse(fine), stays.select("game_id", "language", "body", "source", "rule").unionByName(still)
