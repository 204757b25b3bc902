"""Cleaning, validation and quality profiling.

One ``select`` per table for cleaning and validation; reports are single
aggregate passes. Error listings are top-k by the order column
(``TakeOrderedAndProject``), never a full collect.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.functions.expr import (as_string, digits, percentage, qcol, strip, truthy,
                                       truthy_of, valid_email, valid_key, valid_zip)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
CLEAN_KEY_FIELD = "taxpayer_id"
CLEAN_ZIP_FIELDS = ["zip", "taxpayer_zip", "zip_code"]
CLEAN_PHONE_FIELDS = ["phone", "telephone", "phone_number"]
VALIDATE_ZIP_FIELDS = ["zip", "taxpayer_zip"]
VALIDATE_EMAIL_FIELD = "email"
ERROR_LIMIT = 100


def clean(df: DataFrame) -> DataFrame:
    """Clean every row (J11) in one projection.

    key -> its digits (any length); zip fields -> first five digits (or fewer);
    phone fields -> ``(ddd) ddd-dddd`` for ten digits, else the digits; every
    string value stripped; empty strings -> NULL.
    """
    sel = []
    for f in df.schema.fields:
        c, t = qcol(f.name), f.dataType
        out, is_str = c, isinstance(t, T.StringType)
        if f.name == CLEAN_KEY_FIELD:
            out = F.when(truthy(c, t), digits(c)).otherwise(c.cast("string") if not is_str else c)
            is_str = True
        elif f.name in CLEAN_ZIP_FIELDS:
            out = F.when(truthy(c, t), F.substring(digits(c), 1, 5)).otherwise(
                c if is_str else c.cast("string"))
            is_str = True
        elif f.name in CLEAN_PHONE_FIELDS:
            d = digits(c)
            out = F.when(truthy(c, t),
                         F.when(F.length(d) == 10,
                                F.regexp_replace(d, r"^([0-9]{3})([0-9]{3})([0-9]{4})$", "($1) $2-$3"))
                         .otherwise(d)).otherwise(c if is_str else c.cast("string"))
            is_str = True
        if is_str:
            out = F.nullif(strip(out), F.lit(""))
        sel.append(out.alias(f.name))
    return df.select(*sel)


def _present(df: DataFrame, name: str, null_is_absent: bool) -> Column:
    if name not in df.columns:
        return F.lit(False)
    return qcol(name).isNotNull() if null_is_absent else F.lit(True)


def validation_errors_col(df: DataFrame, required: Sequence[str] = (),
                          null_is_absent: bool = False) -> Column:
    """Ordered error messages of a row as ``array<string>``."""
    msgs = []
    for f in required:
        if f in df.columns:
            msgs.append(F.when(~truthy_of(df, f), F.lit(f"Missing required field: {f}")))
        else:
            msgs.append(F.lit(f"Missing required field: {f}"))
    if "taxpayer_id" in df.columns:
        msgs.append(F.when(_present(df, "taxpayer_id", null_is_absent) & ~valid_key(qcol("taxpayer_id")),
                           F.lit("Invalid taxpayer ID format")))
    zf = next((z for z in VALIDATE_ZIP_FIELDS if z in df.columns), None)
    if zf:
        z = qcol(zf)
        msgs.append(F.when(truthy_of(df, zf) & ~valid_zip(z),
                           F.concat(F.lit("Invalid ZIP code: "), as_string(z, df.schema[zf].dataType))))
    if VALIDATE_EMAIL_FIELD in df.columns:
        e = qcol(VALIDATE_EMAIL_FIELD)
        msgs.append(F.when(truthy_of(df, VALIDATE_EMAIL_FIELD) & ~valid_email(e),
                           F.concat(F.lit("Invalid email: "), e.cast("string"))))
    if not msgs:
        return F.array().cast("array<string>")
    return F.filter(F.array(*msgs), lambda x: x.isNotNull())


def validate(df: DataFrame, required: Sequence[str] = (), null_is_absent: bool = False) -> DataFrame:
    """Add ``errors`` (array<string>) and ``is_valid`` to every row."""
    errs = validation_errors_col(df, required, null_is_absent)
    return df.withColumn("errors", errs).withColumn("is_valid", F.size("errors") == 0)


def validation_summary(validated: DataFrame) -> DataFrame:
    """total / valid / invalid / rate, one pass."""
    a = validated.agg(F.count(F.lit(1)).alias("total_records"),
                      F.count_if(F.col("is_valid")).alias("valid_records"),
                      F.count_if(~F.col("is_valid")).alias("invalid_records"))
    return a.withColumn("validation_rate",
                        percentage(F.col("valid_records"), F.col("total_records")))


def validation_errors(validated: DataFrame, order_by="seq", limit: int = ERROR_LIMIT,
                      with_index: bool = True) -> DataFrame:
    """The first ``limit`` invalid rows by ``order_by`` (F9 / H3), with
    ``record_index`` (0-based position of the row in the whole table)."""
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    errs = validated.where(~F.col("is_valid")).orderBy(*cols).limit(limit)
    if not with_index:
        return errs
    if len(cols) != 1:
        from recordlink.operators.batches import row_index
        v = row_index(validated, order_by, name="record_index")
        return v.where(~F.col("is_valid")).orderBy(*cols).limit(limit)
    return with_positions(validated, errs, cols[0], "record_index")


def validation_report(validated: DataFrame, order_by="seq", limit: int = ERROR_LIMIT):
    """F9 as two frames: the one-row summary and the first ``limit`` errors."""
    return validation_summary(validated), validation_errors(validated, order_by, limit)


def with_positions(table: DataFrame, picked: DataFrame, order_col: str, name: str) -> DataFrame:
    """Add to ``picked`` rows their 0-based position in ``table`` by the unique ``order_col``.

    Only the order column is sorted and numbered (``row_index``: range partitions and one
    count per partition); the picked rows, any number of them, join their position on it.
    """
    from recordlink.operators.batches import row_index
    places = row_index(table.select(F.col(order_col).alias("_rl_po")), "_rl_po", name=name)
    return picked.join(places, F.col(order_col).eqNullSafe(F.col("_rl_po")), "left").drop("_rl_po")


def completeness(df: DataFrame, exclude: Sequence[str] = (), top: int | None = None) -> DataFrame:
    """Per field: truthy count and percentage of all rows, ``(field, pos,
    filled, completeness)`` rows from one wide aggregate + ``unpivot`` (F10, H2).
    ``top`` keeps the most complete fields (ties by column position)."""
    fields = [c for c in df.columns if c not in set(exclude)]
    aggs = [F.count(F.lit(1)).alias("_total")]
    aggs += [F.count_if(truthy_of(df, c)).alias(f"f{i}") for i, c in enumerate(fields)]
    wide = df.agg(*aggs)
    stacked = wide.select("_total", F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.lit(i).alias("pos"), F.col(f"f{i}").alias("filled"))
        for i, c in enumerate(fields)])).alias("x")).select("_total", "x.*")
    out = stacked.select("field", "pos", "filled",
                         percentage(F.col("filled"), F.col("_total")).alias("completeness"))
    if top is not None:
        out = out.orderBy(F.desc("completeness"), F.asc("pos")).limit(top)
    return out


def duplicate_count(df: DataFrame, key_field: str = "taxpayer_id") -> Column:
    """Rows after the first of their raw key value; NULL is one value (G7 count)."""
    if key_field not in df.columns:
        return F.lit(0).cast("bigint")
    k = qcol(key_field)
    return (F.count(F.lit(1)) - F.count_distinct(k)
            - F.max(F.when(k.isNull(), 1).otherwise(0))).cast("bigint")


def quality_report(df: DataFrame, key_field: str = "taxpayer_id", required: Sequence[str] = (),
                   null_is_absent: bool = False) -> DataFrame:
    """Dataset-level quality numbers in one aggregate (F10): total, duplicates
    (raw key, NULL counted as a key) and rate, valid / invalid and rate. Field
    completeness is ``completeness(df)``."""
    errs = validation_errors_col(df, required, null_is_absent)
    d = df.select((F.size(errs) == 0).alias("_rl_valid"),
                  (qcol(key_field) if key_field in df.columns else F.lit(None)).alias("_rl_k"))
    # rows per raw key value first (NULL is one group, as it is one key here);
    # partial aggregation runs before the shuffle, so a hot key costs nothing
    g = d.groupBy("_rl_k").agg(F.count(F.lit(1)).alias("_rl_n"),
                               F.count_if(F.col("_rl_valid")).alias("_rl_v"))
    dup = (F.sum("_rl_n") - F.count(F.lit(1))) if key_field in df.columns else F.lit(0)
    a = g.agg(F.coalesce(F.sum("_rl_n"), F.lit(0)).cast("bigint").alias("total_records"),
              F.coalesce(dup, F.lit(0)).cast("bigint").alias("duplicate_count"),
              F.coalesce(F.sum("_rl_v"), F.lit(0)).cast("bigint").alias("valid_records"),
              F.coalesce(F.sum(F.col("_rl_n") - F.col("_rl_v")), F.lit(0)).cast("bigint")
              .alias("invalid_records"))
    t = F.col("total_records")
    return a.select("total_records", "duplicate_count",
                    percentage(F.col("duplicate_count"), t).alias("duplicate_rate"),
                    "valid_records", "invalid_records",
                    percentage(F.col("valid_records"), t).alias("validation_rate"))
