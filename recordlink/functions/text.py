"""Pattern extraction over text columns, as whole-table jobs (one row per match)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.functions.expr import col_of

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
NUMBER_PATTERN = r"[0-9]+"
EMAIL_FIND_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
URL_PATTERN = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"

PATTERNS = {"numbers": NUMBER_PATTERN, "emails": EMAIL_FIND_PATTERN, "urls": URL_PATTERN}


def find_all(c: Column | str, pattern: str) -> Column:
    """All non-overlapping matches, left to right, as ``array<string>``."""
    return F.regexp_extract_all(col_of(c), F.lit(pattern), 0)


def normalize_int_text(c: Column | str) -> Column:
    """Digit string as ``int(...)`` prints it: leading zeros dropped, ``'0'`` kept."""
    return F.coalesce(F.nullif(F.regexp_replace(col_of(c), "^0+", ""), F.lit("")), F.lit("0"))


def extract(df: DataFrame, text_col: str, kind: str, keep: list[str] | None = None) -> DataFrame:
    """One row per match of ``kind`` (numbers / emails / urls) in ``text_col``.

    Output: ``keep`` columns, ``match_pos`` (0-based position in the text's match
    list) and ``match``. Numbers are printed as integers (leading zeros dropped).
    The whole text is scanned; nothing is truncated.
    """
    pattern = PATTERNS[kind]
    keep = list(keep or [])
    out = df.select(*keep, F.posexplode(find_all(text_col, pattern)).alias("match_pos", "match"))
    if kind == "numbers":
        out = out.withColumn("match", normalize_int_text("match"))
    return out
