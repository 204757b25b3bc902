"""Landed lookup responses: per-key detail objects and status lists.

Remote lookups are re-aimed as tables of landed responses (one row per response,
possibly a raw JSON body). The per-key status list is kept in long form: the
count, flags and first record come from aggregates, not from arrays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.functions.expr import qcol
from recordlink.operators.dedup import order_col, pick_per_key


def parse_status_body(df: DataFrame, body_col: str, schema: str | T.DataType,
                      key: str = "taxpayer_id") -> DataFrame:
    """Raw JSON status bodies -> one row per status record (A10).

    ``from_json`` with an ``array<struct<...>>`` schema reads a single object as a
    one-element array, so object-or-array bodies normalise to a list; a missing
    or unparsable body gives no rows.
    """
    if isinstance(schema, str) and not schema.strip().lower().startswith("array"):
        schema = f"array<{schema}>"
    parsed = df.select(qcol(key), F.posexplode(F.from_json(qcol(body_col), schema)).alias("pos", "rec"))
    return parsed.select(key, "pos", "rec.*")


def status_list(status: DataFrame, taxpayer_id=None, name=None, file_number=None, key: str = "taxpayer_id",
                name_col: str = "name", file_col: str = "file_number") -> DataFrame:
    """Status records of an id, a name or a file number (A10); several parameters must all hold.

    Ids are compared as cleaned keys, names without case and outer blanks, file numbers stripped.
    No parameter at all is an error; a value that nothing matches gives no rows.
    """
    from recordlink.functions.expr import clean_key, strip
    tests = []
    if taxpayer_id:
        tests.append(clean_key(key) == clean_key(F.lit(str(taxpayer_id))))
    if name:
        tests.append(F.lower(strip(qcol(name_col))) == F.lower(strip(F.lit(name))))
    if file_number:
        tests.append(strip(qcol(file_col).cast("string")) == strip(F.lit(str(file_number))))
    if not tests:
        raise ValueError("give a taxpayer_id, a name or a file_number")
    for t in tests:
        status = status.where(t)
    return status


def parse_detail_body(df: DataFrame, body_col: str, schema: str | T.DataType,
                      key: str = "taxpayer_id") -> DataFrame:
    """Raw JSON detail bodies -> one row per key with the detail fields (A10)."""
    return df.select(qcol(key), F.from_json(qcol(body_col), schema).alias("d")).select(key, "d.*")


def account_info(ids: DataFrame, details: DataFrame | None = None, status: DataFrame | None = None,
                 key: str = "taxpayer_id", order_by="seq", include_details: bool = True,
                 include_status: bool = True, errors: DataFrame | None = None) -> DataFrame:
    """One row per requested id (A11, A12, flattened as C16).

    Columns: ``key``, ``has_details``, ``has_ftas``, ``ftas_count``, ``detail_<f>``
    for each detail field (NULL without details), ``ftas_<f>`` of the first status
    record by ``order_by``, and ``error``: the landed failure of the key's lookup from
    ``errors`` (``key, error``; the greatest text where there are several). Switching both parts off gives
    no rows; switching one off gives its empty form.
    """
    req = ids.select(qcol(key)).where(qcol(key).isNotNull()).distinct()
    if not include_details and not include_status:
        return req.limit(0)
    out = req
    dcols: list[str] = []
    if include_details and details is not None:
        dfields = [c for c in details.columns if c != key and c != order_by]
        d = details
        if order_by in details.columns:
            d = pick_per_key(details, qcol(key), order_col(order_by), keep_nulls=False,
                             pick="max", key_out="_rl_dk").drop(key)
        else:
            # no order column: the greatest row, so that every run picks the same one
            d = (details.groupBy(qcol(key).alias("_rl_dk")).agg(F.max(F.struct(*[qcol(c) for c in dfields])).alias("_rl_r"))
                 .select("_rl_dk", "_rl_r.*"))
        d = d.select("_rl_dk", F.lit(True).alias("_rl_hd"),
                     *[qcol(c).alias(f"detail_{c}") for c in dfields])
        out = out.join(d, out[key] == d["_rl_dk"], "left").drop("_rl_dk")
        dcols = [f"detail_{c}" for c in dfields]
    else:
        out = out.withColumn("_rl_hd", F.lit(None).cast("boolean"))
    scols: list[str] = []
    if include_status and status is not None:
        sfields = [c for c in status.columns if c not in (key, order_by)]
        s = (status.groupBy(qcol(key).alias("_rl_sk"))
             .agg(F.count(F.lit(1)).alias("_rl_n"),
                  F.min_by(F.struct(*[qcol(c) for c in sfields]), order_col(order_by)).alias("_rl_f"))
             .select("_rl_sk", "_rl_n", *[F.col(f"_rl_f.{c}").alias(f"ftas_{c}") for c in sfields]))
        out = out.join(s, out[key] == s["_rl_sk"], "left").drop("_rl_sk")
        scols = [f"ftas_{c}" for c in sfields]
    else:
        out = out.withColumn("_rl_n", F.lit(None).cast("bigint"))
    failure = F.lit(None).cast("string")
    if errors is not None:
        e = errors.groupBy(qcol(key).alias("_rl_ee")).agg(F.max("error").alias("_rl_error"))
        out = out.join(e, out[key] == e["_rl_ee"], "left").drop("_rl_ee")
        failure = F.col("_rl_error").cast("string")
    return out.select(
        qcol(key),
        F.coalesce(F.col("_rl_hd"), F.lit(False)).alias("has_details"),
        (F.coalesce(F.col("_rl_n"), F.lit(0)) > 0).alias("has_ftas"),
        F.coalesce(F.col("_rl_n"), F.lit(0)).cast("bigint").alias("ftas_count"),
        *[qcol(c) for c in dcols], *[qcol(c) for c in scols],
        failure.alias("error"))
