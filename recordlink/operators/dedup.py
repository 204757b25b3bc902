"""Deduplication and per-key picking.

Scale notes
-----------
* A key may hold a third of all rows. No operator here uses a window partitioned
  by the key: "first row per key" is a ``min(order, content hash)`` aggregate (partial,
  map-side combined) joined back on (key, order, hash). Per-key picks of whole rows use ``min_by`` /
  ``max_by`` aggregates, which also combine map-side.
* Rows without a key never shuffle: they are split off and unioned back.
* ``order_by`` should be unique; "first" / "last" are defined by it. Where order values
  are NULL or repeat, a key still keeps exactly one row of ``flag_first``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.functions.expr import as_string, qcol, strip, stripped_key, truthy, truthy_of
from recordlink.operators.schema import DEDUP_KEY_FIELDS, FUZZY_KEY_FIELDS, GROUP_KEY_FIELDS

KEY = "_rl_key"
FIRST = "_rl_first"
ORD = "_rl_ord"
PLACE = "_rl_place"


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def order_col(order_by) -> Column:
    """A single orderable Column for one or many order columns."""
    cols = _as_list(order_by)
    return qcol(cols[0]) if len(cols) == 1 else F.struct(*[qcol(c) for c in cols])


def _drop(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


# ---------------------------------------------------------------------------
# Keys for the strategies
# ---------------------------------------------------------------------------

def key_strategy_key(df: DataFrame, key_fields: Sequence[str] | None = None) -> Column:
    """First truthy of the key fields, stripped; blank -> NULL (G1)."""
    return stripped_key(df, key_fields or DEDUP_KEY_FIELDS)


def _canonical_json_value(c: Column, dtype: T.DataType) -> Column:
    """Value with struct fields sorted by name (recursively) and maps as sorted
    entries, so equal content gives equal JSON."""
    if isinstance(dtype, T.StructType):
        fs = sorted(dtype.fields, key=lambda f: f.name)
        return F.when(c.isNotNull(), F.struct(*[_canonical_json_value(c[f.name], f.dataType)
                                                .alias(f.name) for f in fs]))
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(c))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.MapType, T.ArrayType)):
        return F.transform(c, lambda x: _canonical_json_value(x, dtype.elementType))
    return c


def _sorted_maps(c: Column, dtype: T.DataType) -> Column:
    """Value with maps as sorted entries at any depth and struct fields left in order."""
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_sorted_maps(c[f.name], f.dataType).alias(f.name)
                                                for f in dtype.fields]))
    if isinstance(dtype, T.MapType):
        return F.array_sort(F.map_entries(c))
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.StructType, T.MapType, T.ArrayType)):
        return F.transform(c, lambda x: _sorted_maps(x, dtype.elementType))
    return c


def record_hash(df: DataFrame, exclude: Sequence[str] = (), recursive: bool = True) -> Column:
    """md5 of the row's JSON with column names sorted.

    NULL and a missing field are the same; values are type-sensitive (1 vs "1").
    Stable within Spark; not byte-equal to another engine's JSON.
    """
    ex = set(exclude)
    fields = sorted([f for f in df.schema.fields if f.name not in ex], key=lambda f: f.name)
    value = _canonical_json_value if recursive else _sorted_maps
    parts = [value(qcol(f.name), f.dataType).alias(f.name) for f in fields]
    return F.md5(F.to_json(F.struct(*parts)))


def fuzzy_key(df: DataFrame, key_fields: Sequence[str] | None = None) -> Column:
    """Sorted, lower-cased, stripped truthy values of the key fields joined by '|'
    (G4). Truthiness is tested before stripping, so a whitespace-only value adds an
    empty part. No truthy value -> NULL (row kept)."""
    names = [n for n in (key_fields or FUZZY_KEY_FIELDS) if n in df.columns]
    if not names:
        return F.lit(None).cast("string")
    vals = F.array(*[F.when(truthy_of(df, n), F.lower(strip(as_string(qcol(n)))))
                     for n in names])
    kept = F.filter(vals, lambda x: x.isNotNull())
    return F.when(F.size(kept) > 0, F.array_join(F.array_sort(kept), "|"))


# ---------------------------------------------------------------------------
# Flagging
# ---------------------------------------------------------------------------

def flag_first(df: DataFrame, key: Column, order_by, null_keys: str = "keep",
               flag: str = "is_duplicate", keep: str = "first") -> DataFrame:
    """Add ``flag``: false for the first row of each key (by ``order_by``), true
    for every later row.

    null_keys: ``keep`` (rows without key are never duplicates), ``drop`` (they
    are removed), ``group`` / ``one`` (NULL is one more key: its first row
    survives). keep: ``first`` or ``last``.

    Plan: the smallest (order, content hash) per key is a partial aggregate; the rows are then
    flagged by a join on (key, order, hash), NULLs matching, so a hot key is spread by its
    order values and, where those are NULL or repeat, by its contents. Only rows equal in
    every value share a place; one of them is kept, counted in the join's own partitions.
    """
    if null_keys == "one":          # the accelerated path's name for it
        null_keys = "group"
    if null_keys not in ("keep", "drop", "group"):
        raise ValueError(f"null_keys must be keep, drop, group or one, not {null_keys!r}")
    d = df.withColumn(KEY, key).withColumn(ORD, place_order(df, order_by, keep))
    if null_keys == "drop":
        d = d.where(F.col(KEY).isNotNull())
    agg = F.min if keep == "first" else F.max
    loose = d.where(F.col(KEY).isNull()) if null_keys == "keep" else None
    if loose is not None:
        d = d.where(F.col(KEY).isNotNull())
    firsts = (d.groupBy(KEY).agg(agg(ORD).alias(ORD))
              .select(F.struct(KEY, ORD).alias(PLACE), F.lit(True).alias(FIRST)))
    # one type on both sides, nullability included: else the join shuffles by a cast, the ties again
    place = F.struct(KEY, ORD).cast(firsts.schema[PLACE].dataType)
    j = first_at_place(d.withColumn(PLACE, place).join(firsts, PLACE, "left"))
    out = _drop(j.withColumn(flag, ~F.col(FIRST)), KEY, FIRST, ORD, PLACE)
    if loose is not None:
        out = out.unionByName(_drop(loose.withColumn(flag, F.lit(False)), KEY, ORD))
    return out


def content_hash(df: DataFrame) -> Column:
    """64-bit hash of a row's values; maps, which cannot be hashed, as sorted entries."""
    return F.xxhash64(*[_sorted_maps(qcol(f.name), f.dataType) for f in df.schema.fields])


def place_order(df: DataFrame, order_by, keep: str = "first") -> Column:
    """(order, content hash) of a row. A NULL order value comes after all others."""
    h = content_hash(df)
    order = order_col(order_by)
    late = order.isNull() if keep == "first" else order.isNotNull()
    return F.struct(late.alias("late"), order.alias("at"), (h if keep == "first" else F.bitwise_not(h)).alias("hash"))


def first_at_place(joined: DataFrame) -> DataFrame:
    """``FIRST`` true for one row of each place that was joined, false elsewhere. A place is a
    (key, order, hash) value, so the rows of one are equal; they are numbered as they come,
    which needs neither a shuffle nor a sort beyond the join's."""
    w = Window.partitionBy(PLACE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn(FIRST, F.col(FIRST).isNotNull() & (F.count(F.lit(1)).over(w) == 1))


def dedup(df: DataFrame, strategy: str = "key", key_fields: Sequence[str] | None = None,
          order_by="seq", null_keys: str = "keep", key: Column | None = None,
          with_key: str | None = None) -> DataFrame:
    """Flag duplicates (G1-G4, G8). Returns ``df`` plus ``is_duplicate``.

    strategy ``key``: first truthy of ``key_fields``, stripped (unknown strategies
    fall back here); ``exact`` / ``hash``: whole-row content (order column
    excluded); ``fuzzy``: sorted normalised key values. ``key`` overrides the key
    Column. ``with_key`` names an output column holding the key used.
    """
    order_cols = _as_list(order_by)
    if key is None:
        if strategy in ("exact", "hash"):
            key = record_hash(df, exclude=order_cols, recursive=(strategy == "hash"))
        elif strategy == "fuzzy":
            key = fuzzy_key(df, key_fields)
        else:
            key = key_strategy_key(df, key_fields)
    if with_key:
        df = df.withColumn(with_key, key)
        key = F.col(with_key)
    return flag_first(df, key, order_by, null_keys=null_keys)


def unique(flagged: DataFrame, flag: str = "is_duplicate") -> DataFrame:
    return flagged.where(~F.col(flag)).drop(flag)


def duplicates(flagged: DataFrame, flag: str = "is_duplicate") -> DataFrame:
    """Removed rows, e.g. for review export."""
    return flagged.where(F.col(flag)).drop(flag)


def dedup_stats(flagged: DataFrame, flag: str = "is_duplicate") -> DataFrame:
    """original / unique / duplicate counts and the two rates, in one pass (F2)."""
    n = F.count(F.lit(1))
    u = F.count_if(~F.col(flag))
    d = F.count_if(F.col(flag))
    return (flagged.agg(n.alias("original_count"), u.alias("unique_count"),
                        d.alias("duplicate_count"))
            .select("original_count", "unique_count", "duplicate_count",
                    F.when(F.col("original_count") > 0,
                           F.col("duplicate_count") / F.col("original_count") * 100.0)
                    .otherwise(0.0).alias("deduplication_rate"),
                    F.when(F.col("original_count") > 0,
                           (F.col("original_count") - F.col("unique_count"))
                           / F.col("original_count") * 100.0)
                    .otherwise(0.0).alias("reduction_percentage")))


def detect_duplicates(df: DataFrame, key_field: str = "taxpayer_id", order_by="seq") -> DataFrame:
    """Every row after the first of its raw ``key_field`` value; NULL counts as a
    value (G7). A frame without the column has no duplicates."""
    if key_field not in df.columns:
        return df.limit(0)
    return duplicates(flag_first(df, qcol(key_field), order_by, null_keys="group"))


# ---------------------------------------------------------------------------
# Groups, merge, best record
# ---------------------------------------------------------------------------

def duplicate_groups(df: DataFrame, key_fields: Sequence[str] | None = None,
                     key: Column | None = None, key_name: str = "group_key",
                     hot_rows: int | None = None) -> DataFrame:
    """Rows of keys seen more than once (F4), long form: the key and the group
    size are added to each row. Order inside a group is the order column's.

    Groups are never collected into arrays; the count is a partial aggregate
    joined back on the key, with hot keys split over several tasks.
    """
    from recordlink.operators.skew import salted_join
    k = key if key is not None else stripped_key(df, key_fields or GROUP_KEY_FIELDS)
    d = df.withColumn(key_name, k).where(F.col(key_name).isNotNull())
    sizes = (d.groupBy(key_name).agg(F.count(F.lit(1)).alias("group_size"))
             .where(F.col("group_size") > 1))
    return salted_join(d, sizes, key_name, "inner", hot_rows,
                       counts=sizes, count_col="group_size")


def _merge_value(df: DataFrame, name: str, ordc: Column) -> Column:
    """Longest truthy ``str(value)`` (ties: earliest); all falsy -> last value."""
    f = df.schema[name]
    c = qcol(name)
    best = F.min_by(c, F.when(truthy(c, f.dataType),
                              F.struct((-F.length(as_string(c, f.dataType))).alias("l"),
                                       ordc.alias("o"))))
    return F.coalesce(best, F.max_by(c, ordc))


def merge_duplicates(df: DataFrame, key_fields: Sequence[str] | None = None, order_by="seq",
                     key: Column | None = None, count_col: str = "_merged_from_count") -> DataFrame:
    """Collapse each key to one merged row (G5 + F5).

    Per column: the longest truthy value (ties: earliest), or the last value when
    none is truthy. ``count_col`` is the group size for merged groups and NULL for
    single rows and rows without key (which pass through unchanged). The order
    column of a merged row is its group's first. One aggregate, map-side combined.
    """
    order_cols = _as_list(order_by)
    k = key if key is not None else stripped_key(df, key_fields or GROUP_KEY_FIELDS)
    d = df.withColumn(KEY, k)
    ordc = order_col(order_by)
    aggs = []
    for name in df.columns:
        if name in order_cols and len(order_cols) > 1:
            # several order columns belong together: those of the group's first row
            aggs.append(F.min(F.struct(*[qcol(c) for c in order_cols]))[name].alias(name))
        elif name in order_cols:
            aggs.append(F.min(qcol(name)).alias(name))
        else:
            aggs.append(_merge_value(d, name, ordc).alias(name))
    n = F.count(F.lit(1))
    merged = (d.where(F.col(KEY).isNotNull()).groupBy(KEY)
              .agg(*aggs, n.alias("_n"))
              .select(*[qcol(c) for c in df.columns],
                      F.when(F.col("_n") > 1, F.col("_n")).cast("bigint").alias(count_col)))
    rest = (d.where(F.col(KEY).isNull()).drop(KEY)
            .withColumn(count_col, F.lit(None).cast("bigint")))
    return merged.unionByName(rest)


def completeness_score(df: DataFrame, exclude: Sequence[str] = ()) -> Column:
    """+1 per truthy value, +1 more for strings longer than 10 characters."""
    ex = set(exclude)
    parts = []
    for f in df.schema.fields:
        if f.name in ex:
            continue
        c = qcol(f.name)
        t = truthy(c, f.dataType)
        parts.append(F.when(t, 1).otherwise(0))
        if isinstance(f.dataType, T.StringType):
            parts.append(F.when(t & (F.length(c) > 10), 1).otherwise(0))
    if not parts:
        return F.lit(0)
    return sum(parts[1:], parts[0])


RANK = "_rl_rank"


def pick_per_key(df: DataFrame, key: Column, rank: Column, keep_nulls: bool = True,
                 pick: str = "min", key_out: str | None = None,
                 method: str = "aggregate") -> DataFrame:
    """One whole row per key: the row with the smallest (or largest) ``rank``.
    ``rank`` must be unique per row (it ends with the order column).

    ``method="aggregate"`` (default): ``min_by(struct(row), rank)`` in one
    partial (map-side) aggregate - one pass over the input, and its key
    partitioning is reused by a following join on the key. ``method="join"``:
    ``min(rank)`` per key over the key and rank columns only, then a semi-join on
    the unique rank value; it reads the input twice but never sorts whole rows.
    Both keep a hot key out of any single task.
    ``key_out`` also returns the key under that name (key-less rows are then
    dropped).
    """
    cols = [c for c in df.columns if c not in (KEY, RANK)]
    d = df.withColumn(KEY, key)
    if method == "aggregate":
        fn = F.min_by if pick == "min" else F.max_by
        row = F.struct(*[qcol(c) for c in cols])
        g = d.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(fn(row, rank).alias("_r"))
        picked = (g.select(F.col(KEY).alias(key_out), "_r.*") if key_out
                  else g.select("_r.*"))
    else:
        d = d.withColumn(RANK, rank)
        agg = F.min if pick == "min" else F.max
        best = (d.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(agg(RANK).alias(RANK))
                .select(RANK))
        kept = d.where(F.col(KEY).isNotNull()).join(best, RANK, "left_semi")
        picked = (kept.select(F.col(KEY).alias(key_out), *[qcol(c) for c in cols]) if key_out
                  else kept.select(*[qcol(c) for c in cols]))
    if key_out or not keep_nulls:
        return picked
    return picked.unionByName(df.withColumn(KEY, key).where(F.col(KEY).isNull()).drop(KEY))


def best_by_completeness(df: DataFrame, key_fields: Sequence[str] | None = None,
                         order_by="seq", score_col: str | None = "completeness_score",
                         key: Column | None = None) -> DataFrame:
    """Per key, the row with the highest completeness score, ties to the first
    (G6). Rows without key are kept. ``score_col`` adds the score to the output."""
    order_cols = _as_list(order_by)
    k = key if key is not None else stripped_key(df, key_fields or GROUP_KEY_FIELDS)
    score = completeness_score(df, exclude=order_cols)
    d = df.withColumn(score_col or "_score", score)
    rank = F.struct((-F.col(score_col or "_score")).alias("s"), order_col(order_by).alias("o"))
    out = pick_per_key(d, k, rank)
    return out if score_col else out.drop("_score")
