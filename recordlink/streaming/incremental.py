"""Incremental, resumable ingest with Structured Streaming (K1-K6).

New files landing in a folder are picked up by a file-source stream; each
micro-batch is de-duplicated against the keys of all earlier batches, of this run
and of every other run into the same target, and appended.

The stream checkpoint (``checkpointLocation``) is the progress state: a restarted
run processes only files it has not seen. A run is named by the query id that Spark
keeps in its checkpoint, and a batch's output goes to ``run_id=<run>/batch_id=<n>``,
written with ``overwrite``: a replayed batch writes the same rows again, and a run
with a new checkpoint never touches what another run has written. Runs into one
target are to follow one another; a key that two runs write at the same time is kept
by both.

The history is a key index, not a scan of the output. Keys lie in buckets by their
hash; every batch also leaves one bitmap per bucket (a Bloom filter with one hash, 4 KB).
A micro-batch tests its keys against the bitmaps and opens only the buckets in which
one of its keys may lie; there the keys themselves are compared.
"""

from __future__ import annotations

import json
from typing import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.sources.readers import path_exists

RUN_DIR, BATCH_DIR, BUCKET_DIR = "run_id", "batch_id", "bucket"
BUCKETS = 64            # about one per thousand keys keeps the bitmaps sparse
BITMAP_BITS = 32768     # of Spark's bitmap functions


def keys_path(dst: str) -> str:
    """Key table of an ingest target: ``run_id=/batch_id=/bucket=``."""
    return f"{dst.rstrip('/')}_keys"


def bitmaps_path(dst: str) -> str:
    """Bitmaps of the key table: ``run_id=/batch_id=``, one row per bucket."""
    return f"{dst.rstrip('/')}_bitmaps"


def report_path(dst: str) -> str:
    """Counts of every batch: ``run_id=/batch_id=``, one row each."""
    return f"{dst.rstrip('/')}_report"


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The query id in a checkpoint: the same for every restart, another for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _placed(keys: DataFrame, key_col: str, buckets: int) -> DataFrame:
    """``key, bucket, bit`` of non-NULL keys."""
    at = F.pmod(F.xxhash64(F.col(key_col).cast("string")), F.lit(buckets * BITMAP_BITS))
    return (keys.where(F.col(key_col).isNotNull()).select(key_col, at.alias("_rl_at"))
            .select(key_col, F.floor(F.col("_rl_at") / BITMAP_BITS).cast("int").alias(BUCKET_DIR),
                    (F.col("_rl_at") % BITMAP_BITS).alias("_rl_bit")))


def _others(table: DataFrame, run_id: str, batch_id: int) -> DataFrame:
    """Rows of other runs and of this run's earlier batches."""
    return table.where((F.col(RUN_DIR) != run_id) | (F.col(BATCH_DIR) < batch_id))


def write_keys(written: DataFrame, dst: str, key_col: str, run_id: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Index the keys of one written batch."""
    folder = f"{RUN_DIR}={run_id}/{BATCH_DIR}={batch_id}"
    placed = _placed(written.select(key_col), key_col, buckets)
    (placed.select(key_col, BUCKET_DIR).distinct().repartition(BUCKET_DIR)
     .write.mode("overwrite").partitionBy(BUCKET_DIR).parquet(f"{keys_path(dst)}/{folder}"))
    (placed.groupBy(BUCKET_DIR).agg(F.bitmap_construct_agg("_rl_bit").alias("bits"))
     .withColumn("buckets", F.lit(buckets)).write.mode("overwrite").parquet(f"{bitmaps_path(dst)}/{folder}"))


def earlier_keys(batch_keys: DataFrame, dst: str, key_col: str, run_id: str, batch_id: int) -> DataFrame | None:
    """Keys of other runs and earlier batches that ``batch_keys`` may repeat; None when there is no
    history. Reads the bitmaps (4 KB a bucket and batch) and the buckets that may be hit. Only a
    missing table means "no history"; any other failure stops the batch."""
    spark = batch_keys.sparkSession
    if not path_exists(spark, bitmaps_path(dst)):
        return None
    maps = _others(spark.read.parquet(bitmaps_path(dst)), run_id, batch_id)
    # the number of buckets belongs to a batch: targets may be re-bucketed at any time
    sizes = [r["buckets"] for r in maps.select("buckets").distinct().collect()]
    keys = None
    for n in sizes:
        merged = maps.where(F.col("buckets") == n).groupBy(BUCKET_DIR).agg(F.bitmap_or_agg("bits").alias("bits"))
        placed = _placed(batch_keys.select(key_col).distinct(), key_col, n).join(merged, BUCKET_DIR)
        byte = F.conv(F.hex(F.substring(F.col("bits"), (F.floor(F.col("_rl_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = F.getbit(byte, (F.col("_rl_bit") % 8).cast("int")) == 1
        opened = [r[0] for r in placed.where(hit).select(BUCKET_DIR).distinct().collect()]      # at most n numbers
        if not opened:
            continue
        table = _others(spark.read.parquet(keys_path(dst)), run_id, batch_id).where(F.col(BUCKET_DIR).isin(opened))
        table = table.join(maps.where(F.col("buckets") == n).select(RUN_DIR, BATCH_DIR).distinct(), [RUN_DIR, BATCH_DIR], "left_semi")
        keys = table.select(key_col) if keys is None else keys.unionByName(table.select(key_col))
    return keys


def dedup_batch(batch: DataFrame, key_fn: Callable[[DataFrame], Column], key_col: str,
                order_by, seen: DataFrame | None, keep_null: bool = True) -> DataFrame:
    """Rows of one micro-batch whose key was never written before, first per key
    inside the batch; rows without key are kept (K4 over E10)."""
    from recordlink.operators.combine import new_records
    d = batch.withColumn(key_col, key_fn(batch))
    if seen is None:
        seen = d.sparkSession.createDataFrame([], T.StructType([d.schema[key_col]]))
    return new_records(d, seen, key=F.col(key_col), order_by=order_by,
                       existing_key_col=key_col, keep_null=keep_null)


def stream_ingest(spark: SparkSession, src: str, dst: str, checkpoint: str, schema: T.StructType,
                  fmt: str = "json", key_fn: Callable[[DataFrame], Column] | None = None,
                  key_col: str = "taxpayer_id", order_by="seq",
                  max_files_per_trigger: int | None = None, timeout_s: float | None = None,
                  event_time_col: str | None = None, late_after: str = "1 day", buckets: int = BUCKETS) -> list:
    """Process every file not yet seen under ``src`` and stop (``availableNow``).

    Returns the run report: one dict per micro-batch (K6); ``ingest_report`` reads the counts of
    all runs. With ``key_fn`` each batch keeps only keys never written to ``dst`` by any run (first
    per key inside the batch); without it every row is appended. With ``event_time_col`` the stream
    also drops repeated keys inside a watermark (``dropDuplicatesWithinWatermark``), whose state is
    bounded by ``late_after``; the sink anti-join still applies.
    """
    r = spark.readStream.format("json" if fmt in ("json", "jsonl") else fmt).schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = r.load(src)
    if event_time_col and key_fn is not None:
        k = stream.withColumn("_rl_skey", key_fn(stream)).withWatermark(event_time_col, late_after)
        keyed = k.where(F.col("_rl_skey").isNotNull()).dropDuplicatesWithinWatermark(["_rl_skey"])
        stream = keyed.unionByName(k.where(F.col("_rl_skey").isNull())).drop("_rl_skey")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = run_id_of(spark, checkpoint)
        folder = f"{RUN_DIR}={run_id}/{BATCH_DIR}={batch_id}"
        target = f"{dst.rstrip('/')}/{folder}"
        # rows written are counted by the writing plan itself
        read, kept = Observation("read"), Observation("kept")
        # the key de-dup reads the batch more than once: read the files once
        b = batch.persist() if key_fn is not None else batch
        try:
            if key_fn is None:
                out = b.observe(read, F.count(F.lit(1)).alias("rows"))
                keyless = F.count_if(F.lit(False))
            else:
                n_read = b.count()              # fills the cache
                seen = earlier_keys(b.select(key_fn(b).alias(key_col)), dst, key_col, run_id, batch_id)
                out = dedup_batch(b, key_fn, key_col, order_by, seen)
                keyless = F.count_if(F.col(key_col).isNull())
            out = out.observe(kept, F.count(F.lit(1)).alias("rows"), keyless.alias("keyless"))
            out.write.mode("overwrite").parquet(target)
            if key_fn is None:
                n_read = read.get["rows"]
            else:
                # from the rows just written: the key table never names a key the sink lacks
                write_keys(spark.read.schema(out.schema).parquet(target), dst, key_col, run_id, batch_id, buckets)
            counts = [(int(n_read), int(kept.get["rows"]), int(kept.get["keyless"]))]
            (spark.createDataFrame(counts, "rows_read long, rows_written long, rows_without_key long").coalesce(1)
             .withColumn("written_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{report_path(dst)}/{folder}"))
        finally:
            if b is not batch:
                b.unpersist()

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
    return [{"batch_id": p.get("batchId"), "input_rows": p.get("numInputRows"),
             "timestamp": p.get("timestamp")} for p in (json_progress(x) for x in q.recentProgress)]


def json_progress(p) -> dict:
    if isinstance(p, dict):
        return p
    return json.loads(p.json)


def run_report(spark: SparkSession, report: list) -> DataFrame:
    """Run report as a small DataFrame (one row per micro-batch) (K6)."""
    schema = "batch_id long, input_rows long, timestamp string"
    return spark.createDataFrame([(r["batch_id"], r["input_rows"], r["timestamp"]) for r in report],
                                 schema)


def ingest_report(spark: SparkSession, dst: str, expected_rows: int | None = None) -> DataFrame:
    """Progress of a target over all its runs (K6), from the batches' own counts: per run and in all
    (``run_id`` NULL) batches, rows completed, written, skipped as known and without key; with
    ``expected_rows`` also pending rows and percent done of the total line."""
    r = spark.read.parquet(report_path(dst))
    aggs = [F.count(F.lit(1)).alias("batches"), F.sum("rows_read").alias("completed"), F.sum("rows_written").alias("written"),
            (F.sum("rows_read") - F.sum("rows_written")).alias("skipped"), F.sum("rows_without_key").alias("without_key")]
    out = r.rollup(RUN_DIR).agg(*aggs)
    if expected_rows is None:
        return out
    total, done = F.col(RUN_DIR).isNull(), F.col("completed")
    left = F.greatest(F.lit(0), F.lit(int(expected_rows)) - done)
    return out.select("*", F.when(total, left).alias("pending"),
                      F.when(total, F.when(done + left > 0, 100.0 * done / (done + left)).otherwise(0.0)).alias("percent"))


def read_ingested(spark: SparkSession, dst: str) -> DataFrame:
    """Everything written by ``stream_ingest`` (the ``run_id`` and ``batch_id`` folders are columns)."""
    return spark.read.option("mergeSchema", True).parquet(dst)
