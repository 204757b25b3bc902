"""Helpers shared by the operators of this package: scratch tables, salted keys, shared files.

Functions that run inside tasks are pickled by value (see ``__init__``), so executors need
numpy, pyarrow and the tokenizer library but not this package.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict):
    """Inside, the session's settings hold these values; afterwards what they held before."""
    conf = spark.conf
    before = {k: conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def shuffles_freed(spark: SparkSession):
    """Inside, the shuffle files of a query are deleted when it ends. Otherwise they stay until the driver
    happens to collect its garbage, which it does by its own heap and not by the disk that fills."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def keep(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: the lineage ends
    there, so a lost executor costs a re-read and never a second, different computation.
    Its shuffle files are deleted. ``batch_rows``: rows of an Arrow batch at most while it is written,
    where rows hold whole texts."""
    path = shared_path(df.sparkSession, name)
    batches = {"spark.sql.execution.arrow.maxRecordsPerBatch": batch_rows} if batch_rows else {}
    with shuffles_freed(df.sparkSession), settings(df.sparkSession, batches):
        df.write.parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept._llm_path = path
    return kept


def discard(*tables: DataFrame | None) -> None:
    """Delete tables written by ``keep`` that no later step reads."""
    for df in tables:
        if path := getattr(df, "_llm_path", None):
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def tasks_of(spark: SparkSession) -> int:
    """The session's shuffle width, used to size salts and file counts with the cluster."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def salt_of(col: Column, n: int) -> Column:
    """A salt in ``[0, n)`` from a row's own value (deterministic, so retries agree)."""
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def per_key_to_rows(rows: DataFrame, key: list[str], row_id: str, aggs: list[Column],
                    names: list[str]) -> DataFrame:
    """Rows of ``rows`` with ``aggs`` (associative minima, maxima or sums named ``names``)
    over all rows of their ``key``, without ever gathering one key in one task.

    Each key is cut into salts by the row's own id. The aggregate first runs per (key, salt),
    then over the salts of a key (at most ``salts`` rows however many rows the key has), and
    is joined back on (key, salt), of which each holds ``1 / salts`` of a hot key's rows.
    Keys are matched null-safe. ``aggs`` are given as functions of the column name.
    """
    n = 4 * tasks_of(rows.sparkSession)
    salted = rows.withColumn("_salt", salt_of(F.col(row_id), n))
    part = salted.groupBy(*key, "_salt").agg(*[a(c).alias(c) for a, c in zip(aggs, names)])
    whole = part.groupBy(*key).agg(*[a(c).alias(c) for a, c in zip(aggs, names)])
    p, w = part.select(*key, "_salt").alias("p"), whole.alias("w")
    on = [F.col(f"p.{k}").eqNullSafe(F.col(f"w.{k}")) for k in key]
    spread = p.join(w, on, "inner").select(*[F.col(f"p.{k}").alias(f"_k_{k}") for k in key],
                                           F.col("p._salt").alias("_k_salt"),
                                           *[F.col(f"w.{c}").alias(f"_all_{c}") for c in names])
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in key] + [F.col("_salt") == F.col("_k_salt")]
    return (salted.join(spread, on, "inner")
            .drop("_salt", "_k_salt", *[f"_k_{k}" for k in key]))


def running_offsets(totals: DataFrame, part: str, total: str, out: str) -> DataFrame:
    """``part``, ``out``: the sum of ``total`` over all smaller parts.

    ``totals`` holds one row per partition of a written table, so the single-task window
    sees as many rows as the table has partitions, whatever the number of its rows.
    """
    from pyspark.sql import Window
    w = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(total).over(w), F.lit(0)).cast("long").alias(out))


def open_fs(uri: str):
    """(pyarrow file system, path in it) of a folder that driver and executors share."""
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def give_back() -> None:
    """Inside a task: returns memory that the worker's allocators hold free (a worker outlives its tasks)."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # glibc only
        pass


def worker_held(kind: str | None = None) -> dict:
    """Inside a task: what the Python worker keeps of this kind between tasks. Kinds of other operators
    that ran in the worker before are dropped, so that it never holds the words of two."""
    import sys
    import types
    store = sys.modules.setdefault("_llm_worker_store", types.ModuleType("_llm_worker_store")).__dict__
    if [x for x in ("encoders", "samplers", "word_hashes") if x != kind and store.pop(x, None)]:
        give_back()
    return store.setdefault(kind, {}) if kind else {}


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_schema(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)
