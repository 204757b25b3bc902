"""Sinks: JSON / CSV / Parquet outputs, appends, checksum manifests and table
fingerprints (B1-B10).

Writes are distributed (one file per task); the manifest job hashes files on
the executors (``binaryFile`` + ``sha2``; files above ``WHOLE_UP_TO`` bytes as a running digest
over blocks, so that no file becomes one value whatever its size) and verification is a full outer join
of two listings, so no file content passes through the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.functions.expr import qcol

MANIFEST_NAME = "_manifest"
WHOLE_UP_TO = 64 << 20      # larger files are read in blocks


def _flat_for_text(df: DataFrame, sort_columns: bool = True) -> DataFrame:
    """Nested values as JSON text (CSV cannot hold them); columns sorted by name."""
    names = sorted(df.columns) if sort_columns else df.columns
    sel = []
    for n in names:
        t = df.schema[n].dataType
        c = qcol(n)
        sel.append((F.to_json(c) if isinstance(t, (T.StructType, T.ArrayType, T.MapType)) else c).alias(n))
    return df.select(*sel)


def _csv_writer(w):
    # values are written as they are: the CSV writer trims whitespace by default; a quote
    # inside a cell is doubled, as the reader expects
    return (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON Lines, NULL fields kept so every record has every column (B1)."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV with columns sorted by name, nested values as JSON (B2)."""
    _csv_writer(_flat_for_text(df).write.mode(mode)).csv(path)


def write_all(df: DataFrame, base: str, mode: str = "overwrite",
              formats: Sequence[str] = ("json", "csv", "parquet")) -> dict:
    """The same rows in several formats, computed once."""
    p = df.persist()
    try:
        out = {}
        for f in formats:
            path = f"{base.rstrip('/')}/{f}"
            if f == "json":
                write_json(p, path, mode)
            elif f == "csv":
                write_csv(p, path, mode)
            elif f == "parquet":
                p.write.mode(mode).parquet(path)
            else:
                raise ValueError(f"unsupported format {f!r}")
            out[f] = path
        return out
    finally:
        p.unpersist()


def write_append(df: DataFrame, path: str, fmt: str = "parquet",
                 partition_by: Sequence[str] = ()) -> None:
    """Grow an output by adding files; existing files are never rewritten, so an
    unreadable old file cannot be lost (B4). Read back with ``mergeSchema``."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        _csv_writer(_flat_for_text(df).write.mode("append")).csv(path)
    elif fmt == "json":
        df.write.mode("append").option("ignoreNullFields", False).json(path)
    else:
        w.format(fmt).save(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def write_by_source(df: DataFrame, path: str, source_col: str = "source",
                    fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One consolidated output per source value."""
    df.write.mode(mode).partitionBy(source_col).format(fmt).save(path)


def _listing(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(path))


def _block_digests(files: DataFrame, algorithm: str, block_bytes: int) -> DataFrame:
    """``path, checksum`` of listed files, each read by one task in blocks of ``block_bytes``. The
    files must lie where Arrow's file systems reach them (local, hdfs, s3, gs and abfs paths)."""
    def run(batches):
        import hashlib
        from urllib.parse import quote

        import pandas as pd
        import pyarrow.fs as fs
        for pdf in batches:
            for path in pdf["path"]:
                scheme, _, rest = path.partition(":")
                if scheme == "file":
                    store, name = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    store, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
                digest = hashlib.new(algorithm)
                with store.open_input_stream(name) as stream:
                    while block := stream.read(block_bytes):
                        digest.update(block)
                yield pd.DataFrame({"path": [path], "checksum": [digest.hexdigest()]})

    # no contents are read for the listing, so files are dealt out anew, a few per task
    return files.select("path").repartition("path").mapInPandas(run, "path string, checksum string")


def _digests(files: DataFrame, algorithm: str, whole_up_to: int, block_bytes: int) -> DataFrame:
    """``path, checksum`` per file of a listing. The scan drops files above ``whole_up_to`` by
    their length before it opens them."""
    h = F.md5("content") if algorithm == "md5" else F.sha2("content", 256)
    small = files.where(F.col("length") <= whole_up_to).select("path", h.alias("checksum"))
    large = files.where(F.col("length") > whole_up_to)
    return small.unionByName(_block_digests(large, "md5" if algorithm == "md5" else "sha256", block_bytes))


def file_checksums(spark: SparkSession, path: str, algorithm: str = "sha256", glob: str = "*",
                   whole_up_to: int = WHOLE_UP_TO, block_bytes: int = 1 << 20) -> DataFrame:
    """``path, length, modified, algorithm, checksum`` per file, hashed on the executors.
    Spark's file scans leave out files without bytes, so such files have no row."""
    files = _listing(spark, path, glob)
    digests = _digests(files, algorithm, whole_up_to, block_bytes)
    return (files.select("path", "length", F.col("modificationTime").alias("modified"),
                         F.lit("md5" if algorithm == "md5" else "sha256").alias("algorithm"))
            .join(digests, "path"))


def write_manifest(spark: SparkSession, path: str, manifest_path: str | None = None,
                   algorithm: str = "sha256", glob: str = "*") -> str:
    """Checksum manifest of every file under ``path`` (B5); returns its location."""
    mp = manifest_path or f"{path.rstrip('/')}{MANIFEST_NAME}"
    file_checksums(spark, path, algorithm, glob).withColumn(
        "created_at", F.current_timestamp()).write.mode("overwrite").parquet(mp)
    return mp


def verify_manifest(spark: SparkSession, path: str, manifest_path: str | None = None,
                    glob: str = "*", whole_up_to: int = WHOLE_UP_TO, block_bytes: int = 1 << 20) -> DataFrame:
    """Status per file (B6): ``verified``, ``size_mismatch``, ``checksum_mismatch``,
    ``missing`` (listed, not found) or ``untracked`` (found, not listed).
    Sizes are compared first; only files of equal size are hashed."""
    mp = manifest_path or f"{path.rstrip('/')}{MANIFEST_NAME}"
    m = spark.read.parquet(mp).select("path", F.col("length").alias("m_length"),
                                      F.col("checksum").alias("m_checksum"), "algorithm")
    algo_row = m.select("algorithm").limit(1).collect()
    algorithm = algo_row[0][0] if algo_row else "sha256"
    # files may have changed since they were last listed in this session
    spark.catalog.refreshByPath(path)
    files = _listing(spark, path, glob)
    listing = files.select("path", F.col("length").alias("f_length"))
    j = listing.join(m, "path", "full_outer")
    same_size = F.col("f_length") == F.col("m_length")
    need_hash = j.where(same_size).select("path")
    hashed = (_digests(files.join(need_hash, "path", "left_semi"), algorithm, whole_up_to, block_bytes)
              .withColumnRenamed("checksum", "f_checksum"))
    r = j.join(hashed, "path", "left")
    status = (F.when(F.col("m_length").isNull(), F.lit("untracked"))
              .when(F.col("f_length").isNull(), F.lit("missing"))
              .when(~same_size, F.lit("size_mismatch"))
              .when(F.col("f_checksum") != F.col("m_checksum"), F.lit("checksum_mismatch"))
              .otherwise(F.lit("verified")))
    return r.select("path", status.alias("status"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free table fingerprint (B8): row count, sum and xor of per-row
    64-bit hashes. Equal tables give equal fingerprints within Spark."""
    from recordlink.operators.dedup import content_hash
    return df.select(content_hash(df).alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("h").cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"))


def verify_and_load(spark: SparkSession, path: str, fmt: str | None = None,
                    manifest_path: str | None = None, glob: str = "*"):
    """Load a written output after checking its manifest.

    As in the reference, a failed check does not stop the load: the statuses are
    returned beside the data (and a warning is logged) so the caller decides. A
    missing manifest counts as "skipped".
    """
    import logging
    from recordlink.sources.readers import path_exists, read_auto
    mp = manifest_path or f"{path.rstrip('/')}{MANIFEST_NAME}"
    if path_exists(spark, mp):
        statuses = verify_manifest(spark, path, mp, glob)
        bad = statuses.where(F.col("status") != "verified").limit(1).count()
        if bad:
            logging.getLogger(__name__).warning("manifest check failed for %s", path)
    else:       # no manifest: verification skipped; any other failure is raised
        statuses = spark.createDataFrame([(path, "skipped")], "path string, status string")
    return read_auto(spark, path, fmt), statuses


def folder_stats(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Item count and bytes of a cache or work folder (F15); contents not read."""
    files = _listing(spark, path, glob).select("length", "modificationTime")
    return files.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
                     F.max("modificationTime").alias("newest"))
