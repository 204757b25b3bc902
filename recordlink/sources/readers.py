"""File sources: auto-detected JSON / CSV / Parquet, directory merges, landed
pages, newest file, dataset description (A1-A9, A15, H6).

Rows are never loaded on the driver. ``json`` takes JSON Lines, one-document
files (array or object) and indented files, told apart file by file. A one-document
JSON file and a CSV file (whose cells may hold newlines) cannot be split, so large
inputs should land as JSON Lines or be converted once to Parquet (``ingest_to_parquet``).

Malformed records are never dropped silently: ``read_dir_checked`` returns them beside
the good rows; ``read_dir`` logs their number.
"""

from __future__ import annotations

import os
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.operators.dedup import flag_first

FORMATS = {".json": "json", ".jsonl": "jsonl", ".ndjson": "jsonl", ".csv": "csv",
           ".parquet": "parquet"}
CORRUPT = "_corrupt_record"
# File name patterns per format; checksum sidecars (a.json.checksum) do not match.
PATTERNS = {"json": "*.{json,jsonl,ndjson}", "jsonl": "*.{json,jsonl,ndjson}", "csv": "*.csv", "parquet": "*.parquet"}


def _reader(spark: SparkSession, fmt: str, schema=None, options: dict | None = None):
    """A reader for one format. Malformed records are kept (permissive): with a schema
    their text is in ``_corrupt_record``."""
    r = spark.read.options(**{k: str(v) for k, v in (options or {}).items()})
    if schema is not None:
        r = r.schema(schema)
    if fmt == "json":
        r = r.option("multiLine", True)
    if fmt in ("json", "jsonl"):
        r = r.format("json").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    elif fmt == "csv":
        # every value is text; the header names the columns; a UTF-8 BOM is dropped;
        # a quote inside a quoted cell is doubled, and a cell may hold newlines
        r = (r.format("csv").option("header", True).option("inferSchema", False)
             .option("encoding", "UTF-8").option("quote", '"').option("escape", '"').option("multiLine", True)
             .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT))
    elif fmt == "parquet":
        r = r.format("parquet")
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return r


def _whole_value(line: Column) -> Column:
    """A line that holds a whole JSON object or array. NaN and infinities are read as numbers,
    as the JSON reader reads them."""
    finite = F.regexp_replace(line, r"(?<=[:,\[\s])-?(NaN|Infinity|INF)(?=[,\]}\s])", "0")
    return F.when(line.rlike(r"^(?s)(\{.*\}|\[.*\])\s*$"), F.get_json_object(finite, "$").isNotNull()).otherwise(False)


def _json_files(spark: SparkSession, path: str, options: dict | None = None) -> tuple[list, list]:
    """Paths of JSON Lines files and of one-document files; blank files are neither.

    A file is JSON Lines when its first non-blank line is a whole object or array, or when
    most of its lines are: inside one document two such lines never follow each other (a comma
    or bracket stands between), so there they are never the majority. A cut first line costs
    that line only.
    """
    lines = (spark.read.options(**{k: str(v) for k, v in (options or {}).items()}).text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"), F.trim(F.regexp_replace("value", "^\ufeff", "")).alias("value"))
             .where(F.col("value") != "").withColumn("whole", _whole_value(F.col("value"))))
    kinds = (lines.groupBy("file")
             .agg((F.min_by("whole", F.struct("block", "row")) | (2 * F.count_if("whole") > F.count(F.lit(1)))).alias("by_line"))
             .collect())            # one row per input file, like the file listing itself
    return [r["file"] for r in kinds if r["by_line"]], [r["file"] for r in kinds if not r["by_line"]]


def _read_json(spark: SparkSession, path: str, schema=None, options: dict | None = None) -> DataFrame:
    """JSON files of either layout as one frame with ``_rl_file`` and ``_rl_block``."""
    by_line, whole = _json_files(spark, path, options)
    frames = []
    for fmt, files in (("jsonl", by_line), ("json", whole)):
        if files:
            df = _reader(spark, fmt, schema).load(files)
            df = df.withColumn("_rl_file", F.col("_metadata.file_path")).withColumn("_rl_block", F.col("_metadata.file_block_start"))
            frames.append(_unwrap_with_place(df) if schema is None else df)
    if not frames:
        if schema is None:
            return _reader(spark, "json", schema, options).load(path)
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_rl_file", T.StringType()),
                                                       T.StructField("_rl_block", T.LongType())]))
    if len(frames) == 1:
        return frames[0]
    from recordlink.operators.batches import union_all
    return union_all({i: f for i, f in enumerate(frames)}, tag=None)


def _unwrap_with_place(df: DataFrame) -> DataFrame:
    """``unwrap_data`` for a frame that carries its file columns."""
    names = [c for c in df.columns if c not in ("_rl_file", "_rl_block")]
    inner = df.schema[names[0]].dataType if len(names) == 1 and names[0] == "data" else None
    if isinstance(inner, T.ArrayType) and isinstance(inner.elementType, T.StructType):
        return df.select(F.explode("data").alias("_rl_r"), "_rl_file", "_rl_block").select("_rl_r.*", "_rl_file", "_rl_block")
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def detect_format(path: str) -> str:
    ext = os.path.splitext(path.rstrip("/"))[1].lower()
    if ext in (".xlsx", ".xls"):
        raise ValueError("Excel files are not supported; convert to CSV or Parquet")
    if ext not in FORMATS:
        raise ValueError(f"unsupported file type {ext!r}")
    return FORMATS[ext]


def unwrap_data(df: DataFrame, field: str = "data") -> DataFrame:
    """``{"data": [...]}`` wrapper -> its rows (A2); other frames unchanged."""
    f = df.schema.fields
    if len(f) == 1 and f[0].name == field and isinstance(f[0].dataType, T.ArrayType) and \
            isinstance(f[0].dataType.elementType, T.StructType):
        return df.select(F.explode(field).alias("_rl_r")).select("_rl_r.*")
    return df


def read_auto(spark: SparkSession, path: str, fmt: str | None = None, schema=None) -> DataFrame:
    """Read one file (or folder of one format) by its suffix (A1, A3, A4)."""
    fmt = fmt or detect_format(path)
    if fmt == "json":
        return _read_json(spark, path, schema).drop("_rl_file", "_rl_block")
    return _reader(spark, fmt, schema).load(path)


def with_seq(df: DataFrame, name: str = "seq") -> DataFrame:
    """Input-order column: (file path, block start, row id). A frame whose ``seq`` is used
    more than once is written out first (``cut_lineage``), so that all uses agree."""
    placed = "_rl_file" in df.columns
    file, block = ((F.col("_rl_file"), F.col("_rl_block")) if placed
                   else (F.col("_metadata.file_path"), F.col("_metadata.file_block_start")))
    return df.withColumn(name, F.struct(file.alias("file"), block.alias("block"),
                                        F.monotonically_increasing_id().alias("row"))).drop("_rl_file", "_rl_block")


def read_placed(spark: SparkSession, path: str, order_by: str = "seq", fmt: str | None = None) -> DataFrame:
    """One file or folder with its input order, written to the shared folder so that the order
    is fixed for every later use."""
    from recordlink.session import cut_lineage
    fmt = fmt or detect_format(path)
    df = _read_json(spark, path) if fmt == "json" else read_auto(spark, path, fmt)
    return cut_lineage(with_seq(df, order_by))


def read_dir_checked(spark: SparkSession, path: str, fmt: str, schema=None, order_by: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Every file of one format in a folder (A5): ``(rows, malformed)``.

    Both come from one reading that is written to the shared folder, so they agree and
    ``order_by`` is fixed. ``malformed`` holds the order value and text of records that do
    not parse (JSON: not JSON, or a value not of its type; CSV: wrong number of cells), each
    of them kept out of ``rows``. An unreadable file stops the read.
    """
    from recordlink.session import cut_lineage
    options = {"pathGlobFilter": PATTERNS[fmt], "recursiveFileLookup": True}
    if schema is not None and fmt != "parquet" and CORRUPT not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    if fmt in ("json", "jsonl"):
        df = _read_json(spark, path, schema, options)
    elif fmt == "csv" and schema is None:
        # one more text column takes the record when its cells do not fit the header
        names = _reader(spark, fmt, None, options).load(path).columns
        typed = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
        df = _reader(spark, fmt, typed, options).load(path)
    else:
        df = _reader(spark, fmt, schema, options).load(path)
    df = cut_lineage(with_seq(df, order_by))
    if CORRUPT not in df.columns:
        return df, df.sparkSession.createDataFrame([], T.StructType([df.schema[order_by], T.StructField(CORRUPT, T.StringType())]))
    return (df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull()).select(order_by, CORRUPT))


def read_dir(spark: SparkSession, path: str, fmt: str, schema=None, key: Column | None = None,
             key_candidates: Sequence[str] | None = None, order_by: str = "seq",
             dedup: bool = True) -> DataFrame:
    """Every file of one format in a folder (checksum sidecars not matched), with an
    input-order ``seq``; the first row per cleaned key wins and rows without a key are all
    kept (A5). Malformed records are left out and their number is logged; use
    ``read_dir_checked`` to get them."""
    df, malformed = read_dir_checked(spark, path, fmt, schema, order_by)
    n = malformed.count()
    if n:
        import logging
        logging.getLogger(__name__).warning("%d malformed records in %s", n, path)
    if not dedup:
        return df
    if key is None:
        from recordlink.operators.schema import TAXPAYER_ID_FIELDS, resolve_key
        key = resolve_key(df, key_candidates or TAXPAYER_ID_FIELDS)
    flagged = flag_first(df, key, order_by, null_keys="keep")
    return flagged.where(~F.col("is_duplicate")).drop("is_duplicate")


def read_pages(spark: SparkSession, path: str, limit: int | None = None,
               page_pattern: str = r"page[_-]?(\d+)") -> DataFrame:
    """Landed result pages (one JSON file per page) in page order (A7): rows carry
    ``page`` (from the file name) and ``pos``, written to the shared folder so that every later
    use sees the same positions; ``limit`` clips like the paged read."""
    from recordlink.session import cut_lineage
    df = _read_json(spark, path)
    name = F.regexp_extract(F.col("_rl_file"), r"([^/]*)$", 1)
    df = (df.withColumn("page", F.regexp_extract(name, page_pattern, 1).cast("bigint"))
          .withColumn("pos", F.monotonically_increasing_id()).drop("_rl_file", "_rl_block"))
    df = cut_lineage(df).orderBy("page", "pos")
    return df.limit(limit) if limit is not None else df


def file_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files under ``path``: ``path``, ``modified``, ``length`` (contents not read)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(path)
            .select("path", F.col("modificationTime").alias("modified"), "length"))


def latest_file(spark: SparkSession, path: str, glob: str = "*") -> str | None:
    """Path of the newest file (A6). One aggregate row reaches the driver."""
    row = file_listing(spark, path, glob).agg(F.max_by("path", "modified").alias("p")).first()
    return row["p"] if row else None


def latest(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame | None:
    """The newest file of a format in a folder, read."""
    p = latest_file(spark, path, f"*.{fmt}")
    return read_auto(spark, p, fmt) if p else None


def files_newest_first(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """All matching files, newest first."""
    return file_listing(spark, path, glob).orderBy(F.desc("modified"), "path")


def describe_dataset(df: DataFrame) -> DataFrame:
    """Columns, row count and newest input-file time of a file-backed frame."""
    cols = ",".join(df.columns)
    return df.select(F.col("_metadata.file_modification_time").alias("m")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("m").alias("last_modified")).select(
        F.lit(cols).alias("columns"), "rows", "last_modified")


def read_datasets(spark: SparkSession, paths: dict, fmt: str | None = None,
                  limit_per_dataset: int | None = None, tag: str = "dataset_id",
                  order_by: str = "seq") -> DataFrame:
    """Several named datasets as one frame with ``tag`` (A8, A9). A path that does not
    exist is skipped with a warning (its name is absent); any other failure is raised. Each
    can be clipped to its first N rows."""
    from recordlink.operators.batches import union_all
    from recordlink.operators.search import top_n
    frames = {}
    for name, p in paths.items():
        if not path_exists(spark, p):
            import logging
            logging.getLogger(__name__).warning("dataset %s: no such path %s", name, p)
            continue
        kind = fmt or detect_format(p)
        df = _read_json(spark, p) if kind == "json" else read_auto(spark, p, kind)
        frames[name] = with_seq(df, order_by)
    if not frames:
        raise ValueError("no dataset could be read")
    u = union_all(frames, tag=tag)
    if limit_per_dataset is not None:
        u = top_n(u, tag, limit_per_dataset, [order_by])
    return u


def datasets_report(spark: SparkSession, paths: dict, loaded: DataFrame, tag: str = "dataset_id") -> DataFrame:
    """A row of the run report per dataset asked for (A9): its name, ``status`` (``loaded``, ``empty``
    or ``missing``) and the ``rows`` that ``read_datasets`` gave."""
    there = spark.createDataFrame([(n, path_exists(spark, p)) for n, p in paths.items()], f"{tag} string, _rl_there boolean")
    counts = loaded.groupBy(tag).agg(F.count(F.lit(1)).alias("rows"))
    rows = F.coalesce(F.col("rows"), F.lit(0))
    return there.join(counts, tag, "left").select(
        tag, F.when(~F.col("_rl_there"), F.lit("missing")).when(rows == 0, F.lit("empty")).otherwise(F.lit("loaded")).alias("status"),
        rows.alias("rows"))


def ingest_to_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                      partition_by: Sequence[str] = ()) -> None:
    """Write once as Parquet so later reads split and prune."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)

