"""Outlet sub-records: extract, attach first / merged outlet.

The outlet list of a taxpayer is kept in long form (one row per outlet, keyed
by taxpayer and ordered by the order column) instead of an array inside the
taxpayer's row, so a taxpayer with millions of outlets never becomes one giant
value. What the attach operators add to a record is computed with aggregates
(``min_by``, ``count``), which combine map-side before the shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.functions.expr import qcol, stripped_key, truthy_of
from recordlink.operators.dedup import _as_list, order_col
from recordlink.operators.schema import OUTLET_KEY_FIELDS, any_truthy

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
OUTLET_FIELDS = [
    "outlet_number", "outlet_name", "outlet_address", "outlet_city", "outlet_state",
    "outlet_zip_code", "outlet_county_code", "outlet_naics_code",
    "outlet_inside_outside_city_limits_indicator", "outlet_permit_issue_date",
    "outlet_first_sales_date",
]

OKEY = "_rl_okey"


def outlet_fields(df: DataFrame, fields: Sequence[str] = OUTLET_FIELDS) -> list[str]:
    return [f for f in fields if f in df.columns]


def has_outlet(df: DataFrame, fields: Sequence[str] = OUTLET_FIELDS):
    """Any outlet field truthy."""
    return any_truthy(df, fields)


def collect_outlets(df: DataFrame, key_fields: Sequence[str] = OUTLET_KEY_FIELDS,
                    order_by="seq", fields: Sequence[str] = OUTLET_FIELDS,
                    key_name: str = "taxpayer_id") -> DataFrame:
    """Outlets per taxpayer, long form (F6): one row per source row that has any
    outlet field, keyed by the stripped (uncleaned) key; falsy fields are NULL
    (C19). Rows without a key are skipped."""
    fs = outlet_fields(df, fields)
    k = stripped_key(df, key_fields)
    return (df.where(has_outlet(df, fs))
            .select(k.alias(key_name), *[qcol(c) for c in _as_list(order_by)],
                    *[F.when(truthy_of(df, f), qcol(f)).alias(f) for f in fs])
            .where(F.col(key_name).isNotNull()))


def _first_outlets(outlets: DataFrame, key_name: str, order_by, fs) -> DataFrame:
    return (outlets.groupBy(key_name)
            .agg(F.min_by(F.struct(*[qcol(f) for f in fs]), order_col(order_by)).alias("_o"),
                 F.count(F.lit(1)).alias("_n"))
            .select(F.col(key_name).alias(OKEY), "_o.*", "_n"))


def _merged_outlets(outlets: DataFrame, key_name: str, order_by, fs) -> DataFrame:
    """Per taxpayer, per field: the value from the most complete outlet holding
    it (F7): outlets ranked by number of truthy fields (desc), ties by order."""
    score = sum([F.when(qcol(f).isNotNull(), 1).otherwise(0) for f in fs[1:]],
                F.when(qcol(fs[0]).isNotNull(), 1).otherwise(0)) if fs else F.lit(0)
    o = outlets.withColumn("_score", score)
    rank = F.struct((-F.col("_score")).alias("s"), order_col(order_by).alias("o"))
    aggs = [F.min_by(qcol(f), F.when(qcol(f).isNotNull(), rank)).alias(f) for f in fs]
    return (o.groupBy(key_name).agg(*aggs, F.count(F.lit(1)).alias("_n"))
            .withColumnRenamed(key_name, OKEY))


def _attach(base: DataFrame, per_key: DataFrame, fs, key_fields, cond_fn, count_expr,
            flag: str, base_unique: bool = False) -> DataFrame:
    from recordlink.operators.skew import salted_join
    bk = stripped_key(base, key_fields)
    b = base.withColumn("_rl_bk", bk)
    j = salted_join(b, per_key.select(F.col(OKEY).alias("_rl_bk"), F.lit(True).alias(OKEY),
                                      *[qcol(f).alias(f"_rl_o_{f}") for f in fs], "_n"),
                    "_rl_bk", "left", big_unique=base_unique)
    matched = F.col(OKEY).isNotNull()
    do = cond_fn(matched)
    sel = []
    for c in base.columns:
        if c in fs:
            sel.append(F.when(do & F.col(f"_rl_o_{c}").isNotNull(), F.col(f"_rl_o_{c}"))
                       .otherwise(qcol(c)).alias(c))
        else:
            sel.append(qcol(c))
    for f in fs:
        if f not in base.columns:
            sel.append(F.when(do, F.col(f"_rl_o_{f}")).alias(f))
    sel.append(count_expr(do).alias("outlet_count"))
    sel.append(do.alias(flag))
    return j.select(*sel)


def attach_outlets(base: DataFrame, outlets: DataFrame, key_fields: Sequence[str] = OUTLET_KEY_FIELDS,
                   order_by="seq", overwrite: bool = False, key_name: str = "taxpayer_id",
                   fields: Sequence[str] = OUTLET_FIELDS, flag: str = "outlets_attached",
                   base_unique: bool = False) -> DataFrame:
    """Attach outlets to records (E6). ``base_unique`` states that ``base`` has at most one
    row per key, which saves counting its keys.

    A record whose key has outlets and that has no outlet data of its own (or
    ``overwrite``) takes the first outlet's truthy fields at top level and
    ``outlet_count``; ``flag`` marks these records. Others are unchanged.
    """
    fs = [f for f in fields if f in outlets.columns]
    first = _first_outlets(outlets, key_name, order_by, fs)
    own = has_outlet(base, fs)
    return _attach(base, first, fs, key_fields,
                   lambda m: m & (F.lit(overwrite) | ~own),
                   lambda do: F.when(do, F.col("_n")), flag, base_unique)


def attach_merged_outlets(base: DataFrame, outlets: DataFrame,
                          key_fields: Sequence[str] = OUTLET_KEY_FIELDS, order_by="seq",
                          store_all: bool = True, key_name: str = "taxpayer_id",
                          fields: Sequence[str] = OUTLET_FIELDS,
                          flag: str = "outlets_attached", base_unique: bool = False) -> DataFrame:
    """Attach one merged outlet per record (E7): always overwrites the top-level
    outlet fields with the merged truthy values; ``outlet_count`` is set when the
    taxpayer has more than one outlet and ``store_all``."""
    fs = [f for f in fields if f in outlets.columns]
    merged = _merged_outlets(outlets, key_name, order_by, fs)
    return _attach(base, merged, fs, key_fields, lambda m: m,
                   lambda do: F.when(do & F.lit(store_all) & (F.col("_n") > 1), F.col("_n")), flag,
                   base_unique)


def outlet_stats(source: DataFrame, attached: DataFrame, key_fields: Sequence[str] = OUTLET_KEY_FIELDS,
                 fields: Sequence[str] = OUTLET_FIELDS, flag: str = "outlets_attached") -> DataFrame:
    """Outlet statistics as ``(metric, value)`` rows (F8); both attach paths count
    their enriched records."""
    fs = outlet_fields(source, fields)
    k = stripped_key(source, key_fields)
    ho = has_outlet(source, fs)
    # per key first (partial aggregation before the shuffle), then over the keys
    g = source.select(k.alias("k"), ho.alias("ho")).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("ho")).alias("n_ho"))
    s = g.agg(F.sum("n").cast("bigint").alias("total_source_records"),
              F.count("k").alias("unique_taxpayers"),
              F.count_if(F.col("k").isNotNull() & (F.col("n_ho") > 0)).alias("taxpayers_with_outlets"),
              F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n_ho"))), F.lit(0))
              .cast("bigint").alias("total_outlets_found"))
    a = attached.agg(F.count_if(F.col(flag)).alias("records_enriched"),
                     F.count_if(~F.col(flag)).alias("records_unchanged"))
    names_s = ["total_source_records", "unique_taxpayers", "taxpayers_with_outlets",
               "total_outlets_found"]
    names_a = ["records_enriched", "records_unchanged"]
    ls = s.unpivot([], names_s, "metric", "value")
    la = a.unpivot([], names_a, "metric", "value")
    return ls.unionByName(la)
