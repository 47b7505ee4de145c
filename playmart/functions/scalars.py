"""Column-level functions of the ingest (all built-in, JVM-side).

Each function is written as SQL text over an input expression (``*_sql``),
so it can sit inside a ``selectExpr``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playmart import schemas


def clean_game_name_sql(name: str) -> str:
    """Commas become spaces (the staged CSV is comma-separated)."""
    return f"translate({name}, ',', ' ')"


def clean_review_text_sql(text: str) -> str:
    """Newlines, then commas, become spaces; every other character stays."""
    return f"translate({text}, '\\n,', '  ')"


def parse_price_sql(formatted: str) -> str:
    """'₩ 12,000' -> 12000: second space-separated token, commas dropped.

    A value without that token yields NULL instead of failing the batch.
    """
    return f"try_cast(replace(split_part({formatted}, ' ', 2), ',', '') AS INT)"


def parse_release_month_sql(date_text: str) -> str:
    """Localized release date -> 'yyyy-MM'; full date first, then year-month.

    Empty, missing or unparsable text gives NULL.
    """
    tries = ", ".join(f"try_to_timestamp({date_text}, '{p}')" for p in schemas.RELEASE_DATE_PATTERNS)
    return f"date_format(coalesce({tries}), 'yyyy-MM')"


def fold_genres_sql(genres: str) -> str:
    """array<struct<description>> -> labels without inner spaces, joined by
    one space. An empty array gives ''."""
    return f"array_join(transform({genres}, g -> replace(g.description, ' ', '')), ' ')"


def integer_sql(text: str, kind: str = "BIGINT") -> str:
    """SQL reading an integer written as ``12000`` or ``12000.0`` exactly, up
    to 64 bits; NULL where the text is NULL or is no such number."""
    return f"coalesce(try_cast({text} AS {kind}), try_cast(try_cast({text} AS DECIMAL(38,6)) AS {kind}))"


def clean_review_text(text: str) -> Column:
    return F.expr(clean_review_text_sql(text))
