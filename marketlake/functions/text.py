"""String and array helpers (FN-1, FN-2, FN-3, FN-4).  All built-in
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark's trim() removes spaces only; vendor text also carries tabs/newlines.
_LEADING_WS = r"^\s+"
_TRAILING_WS = r"\s+$"


def trim_ws(c) -> Column:
    """Strip all leading/trailing white space (tabs and newlines included)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(c, _LEADING_WS, ""), _TRAILING_WS, "")


def split_explode(df: DataFrame, col: str, sep: str = ",", out: str | None = None,
                  trim: bool = True) -> DataFrame:
    """FN-1: one row per ``sep``-separated token of ``col``.

    A null or empty string gives no row; inner blanks (``"A,,B"``) stay as
    ``''``; each token is white-space trimmed.  ``sep`` is literal text.
    """
    out = out or col
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    src = F.col(col)
    tokens = F.when(src.isNull() | (src == ""), F.array()).otherwise(F.split(src, pattern))
    token = F.col("_tok")
    others = [c for c in df.columns if c != col]
    exploded = df.select(*others, F.explode(tokens).alias("_tok"))
    return exploded.select(*others, (trim_ws(token) if trim else token).alias(out))


def last_token(c, sep: str = ";") -> Column:
    """FN-2: the last ``sep``-delimited token, not trimmed (``"NY; U.S.A"`` →
    ``" U.S.A"``)."""
    c = F.col(c) if isinstance(c, str) else c
    pattern = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    return F.element_at(F.split(c, pattern), -1)


def is_blank(c) -> Column:
    """FLT-6 helper: null or only white space."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (F.trim(c) == "")


def word_tokens(c) -> Column:
    """Whole-text word tokens: lower-cased runs of letters (any script)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")
