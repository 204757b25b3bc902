"""Joins that stay balanced when one key holds a large share of the rows.

AQE splits skewed sort-merge-join partitions only when both join inputs are
plain shuffles. Joining a per-key aggregate (one row per key) back onto a base
table is not that shape, so a key holding a third of the base would land in one
task. ``salted_join`` splits such keys explicitly:

1. count the base rows per key (a partial aggregate over the key column only);
2. keys with more than ``hot_rows`` rows are *hot*; there are at most
   ``rows / hot_rows`` of them. Whether that list is broadcast is left to Spark's
   size checks;
3. a hot key's base rows get a deterministic salt in ``[0, n)`` (a hash of the
   row), where ``n = ceil(rows_of_key / hot_rows)``; its single row on the other
   side is repeated ``n`` times, once per salt. Every other key has salt 0;
4. rows with a NULL key never match; their salt is the whole row hash, so they
   spread over all tasks, however many there are.

The result equals the plain join for inner, left, left-semi and left-anti joins;
only the partitioning differs. The salt is a hash of the whole row, so it is the
same on every re-execution; the rows the operators join carry their unique
order column, so copies of a record still spread.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.functions.expr import qcol

# Rows of one key above which the key is split over several tasks; a session
# can set its own with the ``spark.recordlink.hotRows`` configuration.
HOT_ROWS = 1_000_000
HOT_ROWS_CONF = "spark.recordlink.hotRows"
SALT = "_rl_salt"
NSALT = "_rl_nsalt"


def hot_keys(big: DataFrame, key: str, hot_rows: int = HOT_ROWS,
             counts: DataFrame | None = None, count_col: str = "count") -> DataFrame:
    """``(key, n)`` for keys with more than ``hot_rows`` rows; n = salt count.
    ``counts`` (key, ``count_col``) reuses per-key row counts already computed."""
    if counts is not None:
        c = counts.select(qcol(key), F.col(count_col).alias("_rl_cnt"))
    else:
        c = big.where(qcol(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rl_cnt"))
    return (c.where(F.col("_rl_cnt") > hot_rows)
            .select(qcol(key), F.ceil(F.col("_rl_cnt") / F.lit(hot_rows)).cast("int").alias(NSALT)))


def hot_rows_of(df: DataFrame, hot_rows: int | None = None) -> int:
    """The explicit bound, else the session's ``spark.recordlink.hotRows``, else the default."""
    if hot_rows:
        return int(hot_rows)
    v = df.sparkSession.conf.get(HOT_ROWS_CONF, None)
    return int(v) if v else HOT_ROWS


def salted_join(big: DataFrame, small: DataFrame, key: str, how: str = "left",
                hot_rows: int | None = None, salt_cols: Sequence[str] | None = None,
                counts: DataFrame | None = None, count_col: str = "count",
                big_unique: bool = False) -> DataFrame:
    """Join ``small`` (at most one row per key) onto ``big`` on column ``key``,
    splitting hot keys of ``big`` over several tasks. ``how``: inner, left,
    left_semi or left_anti. ``salt_cols`` (default: all of ``big``) feed the
    row hash that picks a salt. ``counts`` gives per-key row counts of ``big``
    when the caller has them (saves the counting pass). ``big_unique=True`` states
    that ``big`` has at most one row per key: no key can be hot, so no counting."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted_join does not support {how!r}")
    hot_rows = hot_rows_of(big, hot_rows)
    # maps cannot be hashed; any other columns tell the rows of a key apart
    hashable = [c for c in (salt_cols or big.columns) if not _holds_map(big.schema[c].dataType)]
    h = F.xxhash64(*[qcol(c) for c in hashable])
    if big_unique:
        b = big.withColumn(SALT, F.when(qcol(key).isNull(), h).otherwise(F.lit(0)).cast("long"))
        return b.join(small.withColumn(SALT, F.lit(0).cast("long")), [key, SALT], how).drop(SALT)
    hot = hot_keys(big, key, hot_rows, counts, count_col)
    b = big.join(hot, key, "left")
    b = b.withColumn(SALT, F.when(qcol(key).isNull(), h)
                     .when(F.col(NSALT).isNotNull(), F.pmod(h, F.col(NSALT)))
                     .otherwise(F.lit(0)).cast("long")).drop(NSALT)
    s = small.join(hot, key, "left")
    s = s.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"),
                                                (F.coalesce(F.col(NSALT), F.lit(1)) - 1).cast("long"))))
    s = s.drop(NSALT)
    return b.join(s, [key, SALT], how).drop(SALT)


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(_holds_map(f.dataType) for f in dtype.fields)

