"""Helpers for writing Spark SQL expression text."""

from __future__ import annotations

import datetime as _dt


def date_text(as_of) -> str:
    """``yyyy-MM-dd`` of a date, a timestamp or such a text."""
    return as_of.strftime("%Y-%m-%d") if isinstance(as_of, (_dt.date, _dt.datetime)) else str(as_of)


def literal(text: str) -> str:
    """A Spark SQL string literal for ``text`` (backslash escapes)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
