"""Date parsing / formatting with Python ``strptime``-style format strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlink.functions.expr import col_of

# ---------------------------------------------------------------------------
# Strptime directive -> Spark datetime pattern. Single-letter
# month/day/hour patterns accept both "2" and "02", as strptime does.
# ---------------------------------------------------------------------------
STRPTIME_TO_SPARK = {
    "%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s",
    "%y": "yy", "%b": "MMM", "%B": "MMMM", "%f": "SSSSSS", "%p": "a", "%I": "h",
    "%j": "D", "%%": "%",
}
STRPTIME_TO_SPARK_OUT = dict(STRPTIME_TO_SPARK, **{"%m": "MM", "%d": "dd", "%H": "HH",
                                                    "%M": "mm", "%S": "ss", "%I": "hh"})
DEFAULT_DATETIME_FORMAT = "%Y-%m-%d %H:%M:%S"
DEFAULT_DATE_FORMAT = "%Y-%m-%d"


def spark_pattern(fmt: str, output: bool = False) -> str:
    """Translate a strptime format into a Spark datetime pattern (plan time)."""
    table = STRPTIME_TO_SPARK_OUT if output else STRPTIME_TO_SPARK
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            d = fmt[i:i + 2]
            if d not in table:
                raise ValueError(f"unsupported directive {d!r}")
            out.append(table[d])
            i += 2
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if ch.isalpha() else ("''" if ch == "'" else ch))
            i += 1
    return "".join(out)


def parse_datetime(c: Column | str, fmt: str = DEFAULT_DATETIME_FORMAT) -> Column:
    """Timestamp, or NULL when the text does not match ``fmt``."""
    return F.try_to_timestamp(col_of(c).cast("string"), F.lit(spark_pattern(fmt)))


def valid_date(c: Column | str, fmt: str = DEFAULT_DATE_FORMAT) -> Column:
    return F.coalesce(parse_datetime(c, fmt).isNotNull(), F.lit(False))


def format_datetime(c: Column | str, fmt: str = DEFAULT_DATETIME_FORMAT) -> Column:
    return F.date_format(col_of(c), spark_pattern(fmt, output=True))


def timestamp_to_datetime(c: Column | str) -> Column:
    return F.timestamp_seconds(col_of(c))


def datetime_to_timestamp(c: Column | str) -> Column:
    return F.unix_timestamp(col_of(c))
