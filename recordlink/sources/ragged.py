"""Ragged records as VARIANT (A1, A2, C15): a field may be a number in one record and an object
in the next, so no column type fits all of them.

``read_records`` keeps each record whole as one VARIANT, ``path_types`` counts which kinds stand
at which path in one scan, and ``shred`` turns the paths that are frequent enough into typed
columns when the plan is built. The record stays beside them, so no value is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlink.functions.expr import qcol
from recordlink.sources.readers import CORRUPT, _json_files

KINDS = ("integer", "number", "string", "boolean", "object", "array", "null")
_MAP, _LIST = "map<string,variant>", "array<variant>"


def kind_of(value: Column) -> Column:
    """One of ``KINDS`` for a VARIANT value; NULL for no value. Dates and other scalars of a
    VARIANT that was not read from JSON count as strings."""
    t = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (F.when(value.isNull(), None).when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
            .when(t.isin("DECIMAL", "DOUBLE", "FLOAT"), "number").when(t == "BOOLEAN", "boolean")
            .when(t == "OBJECT", "object").when(t == "ARRAY", "array").when(t == "VOID", "null").otherwise("string"))


def get_path(record: Column | str, path: str, dtype: str, default=None) -> Column:
    """Value at a VARIANT path cast to ``dtype``; ``default`` where it is missing or does not cast."""
    got = F.try_variant_get(record, path, dtype)
    return got if default is None else F.coalesce(got, F.lit(default).cast(dtype))


def read_records(spark: SparkSession, path: str, wrapper: str | None = "data") -> DataFrame:
    """JSON files of either layout as ``record`` (VARIANT) and ``_corrupt_record``.

    An array gives one row per element, and so does an object that holds only an array named
    ``wrapper``. Text that is not JSON gives a row with its text and no record.
    """
    by_line, whole = _json_files(spark, path)
    frames = []
    for files, one in ((by_line, False), (whole, True)):
        if files:
            frames.append(spark.read.text(files, wholetext=one))
    if not frames:
        return spark.sql(f"SELECT parse_json('0') AS record, '' AS {CORRUPT}").limit(0)
    text = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    text = text.select(F.trim(F.regexp_replace("value", "^\ufeff", "")).alias("value")).where(F.col("value") != "")
    v = text.withColumn("v", F.try_parse_json("value"))
    if wrapper is not None:
        inner = F.map_values(F.try_variant_get("v", "$", _MAP))
        wrapped = (F.size(inner) == 1) & F.map_contains_key(F.try_variant_get("v", "$", _MAP), wrapper) & \
            (kind_of(F.element_at(inner, 1)) == "array")
        v = v.withColumn("v", F.when((kind_of(F.col("v")) == "object") & wrapped, F.element_at(inner, 1)).otherwise(F.col("v")))
    items = F.when(kind_of(F.col("v")) == "array", F.try_variant_get("v", "$", _LIST)).otherwise(F.array("v"))
    return (v.select(F.when(F.col("v").isNull(), F.col("value")).alias(CORRUPT), F.explode(items).alias("record"))
            .select("record", CORRUPT))


def _step(name: Column) -> Column:
    """A path step; names that are no plain words are quoted."""
    return (F.when(name.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), name))
            .when(name.contains("'"), F.concat(F.lit('["'), name, F.lit('"]'))).otherwise(F.concat(F.lit("['"), name, F.lit("']"))))


def _fields(value: Column, path: Column) -> Column:
    """``array<struct<path, value>>`` of an object's fields; empty for anything else."""
    entries = F.when(kind_of(value) == "object", F.map_entries(F.try_variant_get(value, "$", _MAP)))
    return F.coalesce(F.transform(entries, lambda e: F.struct(F.concat(path, _step(e["key"])).alias("path"),
                                                              e["value"].alias("value"))), F.array())


def path_types(df: DataFrame, record: str = "record", depth: int = 3) -> DataFrame:
    """``path`` and the number of records per kind (``n_integer`` ... ``n_null``) down to ``depth``
    nested objects. One scan; counts are combined before the shuffle, so a path that every
    record has costs one row a task."""
    rows = df.select(F.explode(_fields(qcol(record), F.lit("$"))).alias("f"))
    seen = F.array("f")
    level = rows.select(F.col("f"), seen.alias("level"), seen.alias("all"))
    for _ in range(depth - 1):
        level = (level.withColumn("level", F.flatten(F.transform("level", lambda e: _fields(e["value"], e["path"]))))
                 .withColumn("all", F.concat("all", "level")))
    found = level.select(F.explode("all").alias("f")).select("f.path", kind_of(F.col("f.value")).alias("kind"))
    return found.groupBy("path").agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS])


def shred(df: DataFrame, record: str = "record", min_share: float = 0.1, depth: int = 3) -> DataFrame:
    """``df`` with a typed column per path and scalar kind that at least ``min_share`` of the
    records have, named ``path_kind`` (``a_b_integer``); NULL where a record has another kind
    there. A path that holds whole and broken numbers gives one ``number`` column.

    The driver gets the frequent paths only: at most (fields of a record) / ``min_share`` rows,
    whatever the number of records.
    """
    n = df.where(qcol(record).isNotNull()).count()
    numbers = F.col("n_integer") + F.col("n_number")
    picks = []
    for kind, count in (("integer", F.when(F.col("n_number") == 0, numbers)), ("number", F.when(F.col("n_number") > 0, numbers)),
                        ("string", F.col("n_string")), ("boolean", F.col("n_boolean"))):
        picks.append(F.when(count >= F.lit(min_share * n), kind))
    frequent = (path_types(df, record, depth).select("path", F.explode(F.array_compact(F.array(*picks))).alias("kind"))
                .orderBy("path", "kind").collect()) if n else []
    types = {"integer": "bigint", "number": "double", "string": "string", "boolean": "boolean"}
    out, names = [], {c.lower() for c in df.columns}
    for r in frequent:
        value = F.try_variant_get(qcol(record), r["path"], "variant")
        own = kind_of(value).isin("integer", "number") if r["kind"] == "number" else kind_of(value) == r["kind"]
        words = "_".join(w for w in "".join(c if c.isalnum() or c == "_" else " " for c in r["path"]).split())
        name, i = f"{words}_{r['kind']}", 2
        while name.lower() in names:
            name, i = f"{words}_{r['kind']}_{i}", i + 1
        names.add(name.lower())
        out.append(F.when(own, F.try_variant_get(qcol(record), r["path"], types[r["kind"]])).alias(name))
    return df.select("*", *out)
