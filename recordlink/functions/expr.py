"""Column expressions shared by every operator (truthiness, keys, zip, phone, e-mail).

All functions return ``Column`` objects built from ``pyspark.sql.functions`` so that
they stay inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
# Valid key length after dropping non-digits (inclusive bounds).
KEY_MIN_DIGITS = 9
KEY_MAX_DIGITS = 11
# Anchored e-mail pattern used for validation.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# US phone numbers have exactly this many digits.
PHONE_DIGITS = 10

# Python's ``str.strip()`` removes Unicode whitespace; Spark's ``trim`` only spaces.
_WS_EDGES = r"(?U)^\s+|\s+$"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def truthy(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """"Has data" in the sense of a Python ``if value:`` test, per type.

    string: not null and not ''  (whitespace-only is truthy)
    number: not null and not 0   (NaN is truthy)
    bool:   true
    array/map: not null and non-empty
    other:  not null
    """
    c = col_of(c)
    if dtype is None or isinstance(dtype, T.StringType):
        if dtype is None:
            return c.isNotNull() & (c.cast("string") != F.lit(""))
        return c.isNotNull() & (c != F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(dtype, T.NumericType):
        return c.isNotNull() & (c != F.lit(0))
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def truthy_of(df: DataFrame, name: str) -> Column:
    """``truthy`` of a named column, typed from the frame's schema."""
    return truthy(F.col(_q(name)), dtype_of(df, name))


def _q(name: str) -> str:
    """Quote a column name for ``F.col`` (names may hold dots or spaces)."""
    return "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    return F.col(_q(name))


def as_string(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """``str(value)`` for scalar values; nested values become JSON."""
    c = col_of(c)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (Python ``str.strip``)."""
    return F.regexp_replace(col_of(c).cast("string"), _WS_EDGES, "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col_of(c), F.lit(""))


def digits(c: Column | str) -> Column:
    """ASCII digits of the value, in order."""
    return F.regexp_replace(col_of(c).cast("string"), "[^0-9]", "")


def valid_key(c: Column | str) -> Column:
    """Key validation: truthy and 9 to 11 digits once non-digits are dropped."""
    d = digits(c)
    return F.coalesce(
        truthy(c) & F.length(d).between(KEY_MIN_DIGITS, KEY_MAX_DIGITS), F.lit(False))


def clean_key(c: Column | str) -> Column:
    """The key's digits if there are 9 to 11 of them, else NULL."""
    d = digits(c)
    return F.when(F.length(d).between(KEY_MIN_DIGITS, KEY_MAX_DIGITS), d)


def valid_zip(c: Column | str) -> Column:
    """Stripped, dashes removed: exactly 5 or 9 ASCII digits."""
    s = F.regexp_replace(strip(c), "-", "")
    return F.coalesce(truthy(c) & s.rlike(r"^([0-9]{5}|[0-9]{9})$"), F.lit(False))


def format_zip(c: Column | str) -> Column:
    """5 digits as is, 9 digits as ``12345-6789``, other >5 the first five, else NULL."""
    d = digits(c)
    n = F.length(d)
    return (F.when(~truthy(c), F.lit(None).cast("string"))
            .when(n == 5, d)
            .when(n == 9, F.concat(F.substring(d, 1, 5), F.lit("-"), F.substring(d, 6, 4)))
            .when(n > 5, F.substring(d, 1, 5)))


def valid_phone(c: Column | str) -> Column:
    return F.coalesce(truthy(c) & (F.length(digits(c)) == PHONE_DIGITS), F.lit(False))


def format_phone(c: Column | str) -> Column:
    """10 digits as ``(ddd) ddd-dddd``; otherwise the digits, or NULL when none."""
    d = digits(c)
    return (F.when(~truthy(c), F.lit(None).cast("string"))
            .when(F.length(d) == PHONE_DIGITS,
                  F.regexp_replace(d, r"^([0-9]{3})([0-9]{3})([0-9]{4})$", "($1) $2-$3"))
            .when(F.length(d) > 0, d))


def valid_email(c: Column | str) -> Column:
    return F.coalesce(truthy(c) & col_of(c).cast("string").rlike(EMAIL_PATTERN), F.lit(False))


def first_truthy(df: DataFrame, names: Iterable[str], cast_string: bool = True) -> Column:
    """Value of the first listed column (that exists) holding a truthy value."""
    parts = []
    for n in names:
        if n in df.columns:
            v = qcol(n)
            parts.append(F.when(truthy_of(df, n), v.cast("string") if cast_string else v))
    if not parts:
        return F.lit(None).cast("string")
    return F.coalesce(*parts) if len(parts) > 1 else parts[0]


def stripped_key(df: DataFrame, names: Sequence[str]) -> Column:
    """First truthy of ``names``, ``str().strip()``-ed; blank after strip -> NULL."""
    return F.nullif(strip(first_truthy(df, names)), F.lit(""))


def str_len(c: Column | str, dtype: T.DataType | None = None) -> Column:
    """``len(str(value))`` as Spark prints the value."""
    return F.length(as_string(c, dtype))


def percentage(part: Column, total: Column, decimals: int | None = None) -> Column:
    """``part / total * 100`` with 0 for a zero total, optionally rounded."""
    p = F.coalesce(F.try_divide(part.cast("double"), total.cast("double")), F.lit(0.0)) * 100.0
    return F.round(p, decimals) if decimals is not None else p


def safe_int(c: Column | str, default: int = 0) -> Column:
    """``int(value)`` or the default: strings with a fraction fail, doubles truncate."""
    return F.coalesce(col_of(c).try_cast("bigint"), F.lit(default).cast("bigint"))


def safe_float(c: Column | str, default: float = 0.0) -> Column:
    return F.coalesce(col_of(c).try_cast("double"), F.lit(default).cast("double"))


def clamp(c: Column | str, lo, hi) -> Column:
    return F.greatest(F.lit(lo), F.least(col_of(c), F.lit(hi)))
