"""User-function lookups over Arrow batches (L1-L3, E11 + L2) and resumable lookup runs (K3).

``fetch_fn`` is the user's per-key lookup (for example a remote call). It runs
inside ``mapInPandas`` on the executors; Arrow batches bound the memory, and a
failing key becomes an ``error`` row instead of failing the task. At most
``max_parallel`` tasks with ``window`` calls each are in flight; results leave a
task as they end, and a call that takes longer than ``timeout_s`` becomes an error
row while the others go on. Only keys not found in the cache are looked up, and
each distinct key is looked up once.
"""

from __future__ import annotations

import sys
from typing import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Task functions travel by value: executors need not be able to import this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def map_batches(df: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """Apply ``fn(pandas.DataFrame) -> pandas.DataFrame`` to Arrow batches (L1). The batch size
    is the session's ``spark.sql.execution.arrow.maxRecordsPerBatch``."""
    def run(it: Iterator):
        for pdf in it:
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def transform(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Whole-frame user transformation (L3)."""
    return df.transform(fn)


def calls_in_flight(keys: Iterator, fetch_fn: Callable, window: int, timeout_s: float | None = None) -> Iterator[tuple]:
    """``(key, result, error text or None)`` of every key as its call ends, with at most ``window``
    calls running. A call beyond its time is given up: its key is an error, its thread is left to
    end by itself and its place in the window is free again."""
    import queue
    import threading
    import time
    ended: queue.SimpleQueue = queue.SimpleQueue()
    running: dict[int, tuple] = {}
    keys, number, more = iter(keys), 0, True

    def call(ticket, key):
        try:
            ended.put((ticket, fetch_fn(key), None))
        except Exception as e:  # noqa: BLE001 - a failed key is an error row
            ended.put((ticket, None, f"{type(e).__name__}: {e}"))

    while True:
        while more and len(running) < window:
            try:
                key = next(keys)
            except StopIteration:
                more = False
                break
            number += 1
            running[number] = (key, time.monotonic() + timeout_s if timeout_s else None)
            threading.Thread(target=call, args=(number, key), daemon=True).start()
        if not running:
            return
        # tickets start in order, so the first one running is the first to run out of time
        until = next(iter(running.values()))[1]
        try:
            ticket, got, error = ended.get(timeout=None if until is None else max(0.0, until - time.monotonic()))
        except queue.Empty:
            ticket = next(iter(running))
            got, error = None, f"TimeoutError: no answer in {timeout_s:g} s"
        if ticket in running:               # else: an answer after its time
            yield running.pop(ticket)[0], got, error


def lookup_batch(keys: DataFrame, key: str, fetch_fn: Callable[[str], dict | None],
                 schema: T.StructType, max_parallel: int | None = None, cache: DataFrame | None = None,
                 cache_key: str | None = None, cache_order: str | None = None,
                 window: int = 1, timeout_s: float | None = None) -> DataFrame:
    """Look up each distinct key once (L2).

    Output: ``key``, the ``schema`` fields, ``error`` (text or NULL) and
    ``from_cache``. Cached rows (``cache`` holding ``key`` and the schema fields)
    are used as they are, the last one per key by ``cache_order`` (without it the greatest
    row); the rest go to ``fetch_fn`` in ``max_parallel`` partitions (default: the session's
    parallelism), ``window`` calls at a time in each, ``timeout_s`` for each call. ``fetch_fn``
    returns a dict of schema fields or None (not found).
    Every action on the result runs the lookups again: ``persist`` it (or write
    it) before using it twice.
    """
    ck = cache_key or key
    k = keys.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
    field_names = [f.name for f in schema.fields]
    out_schema = T.StructType([T.StructField(key, T.StringType()), *schema.fields,
                               T.StructField("error", T.StringType())])
    hits = None
    todo = k
    if cache is not None:
        c = cache.select(F.col(ck).cast("string").alias(key),
                         *[F.col(n).cast(schema[n].dataType).alias(n) for n in field_names],
                         *([F.col(cache_order).alias("_rl_co")] if cache_order else []))
        row = F.struct(*[F.col(n) for n in field_names])
        c = c.groupBy(key).agg((F.max_by(row, "_rl_co") if cache_order else F.max(row)).alias("_rl_r")).select(key, "_rl_r.*")
        hits = c.join(k, key, "left_semi").withColumn("error", F.lit(None).cast("string"))
        todo = k.join(c.select(key), key, "left_anti")

    def run(it: Iterator):
        import pandas as pd
        columns, rows = [key, *field_names, "error"], []
        # the window stays full across Arrow batches
        for kv, got, error in calls_in_flight((kv for pdf in it for kv in pdf[key].tolist()), fetch_fn, window, timeout_s):
            try:
                values = [(got or {}).get(n) for n in field_names]
            except Exception as e:  # noqa: BLE001 - an answer of another kind is an error row too
                values, error = [None] * len(field_names), f"{type(e).__name__}: {e}"
            rows.append((kv, *values, error))
            if len(rows) >= 1000:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    fetched = todo.repartition(max_parallel or keys.sparkSession.sparkContext.defaultParallelism, key).mapInPandas(run, out_schema) \
        .withColumn("from_cache", F.lit(False))
    if hits is None:
        return fetched
    return hits.withColumn("from_cache", F.lit(True)).unionByName(fetched)


def append_to_cache(results: DataFrame, cache_path: str, cache_errors: bool = False,
                    key: str | None = None) -> None:
    """Append freshly fetched rows to a Parquet cache table (E11). Rows that came
    from the cache are not written again; error rows and not-found rows (every field
    but the key, the first column unless named, is NULL) only with ``cache_errors``."""
    new = results.where(~F.col("from_cache"))
    if not cache_errors:
        fields = [c for c in results.columns if c not in (key or results.columns[0], "error", "from_cache")]
        found = F.exists(F.array(*[F.col(c).isNotNull() for c in fields]), lambda x: x)
        new = new.where(F.col("error").isNull() & found)
    new.drop("from_cache").write.mode("append").parquet(cache_path)


def lookup_run(spark: SparkSession, src: str, dst: str, checkpoint: str, key: str, fetch_fn: Callable, schema: T.StructType,
               fmt: str = "parquet", max_files_per_trigger: int | None = None, **how) -> DataFrame:
    """Look up every key that lands under ``src``, resumably (K3); returns ``read_lookups``.

    A file stream of keys, one folder of result and failure rows per micro-batch
    (``attempt=0/batch_id=<n>``). The checkpoint remembers the files taken; a batch whose folder is
    complete is not fetched again when it is replayed, and keys answered by earlier batches are left
    out. So a run that was stopped goes on where it was: at most the keys of the batch in which it
    stopped are asked twice. ``how`` goes to ``lookup_batch`` (``window``, ``timeout_s``, ...).
    """
    from recordlink.sources.readers import path_exists
    r = spark.readStream.schema(T.StructType([T.StructField(key, T.StringType())])).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)

    def one(batch: DataFrame, batch_id: int) -> None:
        folder = f"{dst.rstrip('/')}/attempt=0/batch_id={batch_id}"
        if path_exists(spark, f"{folder}/_SUCCESS"):
            return
        todo = batch
        if path_exists(spark, dst):
            done = spark.read.parquet(dst).where((F.col("batch_id") != batch_id) | (F.col("attempt") != 0))
            todo = batch.join(done.where("error is null").select(key), key, "left_anti")
        lookup_batch(todo, key, fetch_fn, schema, **how).drop("from_cache").write.mode("overwrite").parquet(folder)

    q = r.load(src).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return read_lookups(spark, dst, key)


def retry_failed(spark: SparkSession, dst: str, key: str, fetch_fn: Callable, schema: T.StructType, **how) -> DataFrame:
    """Ask once more for the keys whose last answer is an error, and only for those; their rows go
    to the next ``attempt``. Returns ``read_lookups``."""
    last = read_lookups(spark, dst, key)
    attempt = spark.read.parquet(dst).agg(F.max("attempt")).first()[0] + 1
    failed = last.where("error is not null").select(key)
    (lookup_batch(failed, key, fetch_fn, schema, **how).drop("from_cache")
     .write.mode("overwrite").parquet(f"{dst.rstrip('/')}/attempt={attempt}/batch_id=0"))
    return read_lookups(spark, dst, key)


def read_lookups(spark: SparkSession, dst: str, key: str) -> DataFrame:
    """Each key's last answer: ``key``, the fields, ``error`` and ``attempt``; an answer beats an error."""
    rows = spark.read.parquet(dst)
    fields = [c for c in rows.columns if c not in (key, "batch_id")]
    newest = F.struct(F.col("error").isNull(), F.col("attempt"), F.col("batch_id"))
    return rows.groupBy(key).agg(F.max_by(F.struct(*fields), newest).alias("_rl_r")).select(key, "_rl_r.*")
