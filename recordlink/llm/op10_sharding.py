"""Sharding by proportional stratified interleaving (law ``rows``).

Within each source the rows are ranked in a seeded shuffle. Row ``r`` of a source with ``n``
rows gets the fraction ``(r - 1/2) / n``; all rows are ordered by that fraction and cut into
``shards`` runs whose sizes differ by at most one, so each shard holds each source in
proportion (to within one row per source and cut).

Ranks come from range-partitioned sorts with per-partition counts added up, never from one
task per source: a source with a third of the rows is spread over as many tasks. Both sorts
are written to the shared folder before their positions are counted, so positions and counts
always come from the same partitions, also after a lost executor. Only ids, hashes and sizes
are shuffled, not texts.

Edge cases: null sources form one stratum; null ids and texts are kept (null text: 16 bytes,
crc 0); repeated rows get slots of their own; an empty table returns no rows; fewer rows than
shards leave shards empty; other columns are ignored by ``assign_shards`` and written by
``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import keep, tasks_of


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """Write a sorted frame with its partition number and the row's place in it. The places
    are counted by the task itself, in the order of its own sorted rows."""
    place = F.monotonically_increasing_id()
    return keep(df.withColumn("_part", F.shiftright(place, 33).cast("int"))
                .withColumn("_place", place.bitwiseAND(F.lit((1 << 33) - 1))), name)


def assign_shards(docs: DataFrame, shards: int = 40, seed: int = 0, id_col: str = "doc_id",
                  text_col: str = "text", strata_col: str = "source") -> DataFrame:
    """``doc_id, size, text_crc32, source, shard, slot``: one row per input row."""
    return _assigned(docs, shards, seed, id_col, text_col, strata_col, [])


def _assigned(docs: DataFrame, shards: int, seed: int, id_col: str, text_col: str, strata_col: str,
              also: list[str]) -> DataFrame:
    """``assign_shards``, with the columns ``also`` carried through both sorts; they break ties."""
    from pyspark.sql import Window
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.col(text_col).cast("string")
    tasks = tasks_of(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(strata_col).cast("string").alias("source"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), *also)
    order = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text_crc32")
    rows = rows.withColumn("_order", order)

    # Sort one: by source and seeded hash. The key holds the hash, so one source spans many tasks.
    by = [F.col("source").asc_nulls_first(), "_order", "doc_id", "text_crc32", "size", *also]
    ranked = _numbered(rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by), "rank")
    # One row per (partition, source) present; a sorted run meets few sources per partition.
    runs = ranked.groupBy("source", "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    w = Window.partitionBy("source").orderBy("_part")
    runs = runs.select(F.col("source").alias("_source"), F.col("_part").alias("_p"), "_first",
                       (F.sum("_n").over(w) - F.col("_n")).alias("_before"),
                       F.sum("_n").over(Window.partitionBy("source")).alias("_total"))
    fraction = (F.col("_before") + F.col("_place") - F.col("_first") + 0.5) / F.col("_total")
    placed = (ranked.join(runs, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_p")))
              .select("doc_id", "source", "size", "text_crc32", "_order", *also, fraction.alias("_fraction")))

    # Sort two: by fraction; counts per partition (one row each) give global positions.
    by = ["_fraction", "_order", F.col("source").asc_nulls_first(), "doc_id", "text_crc32", "size", *also]
    mixed = _numbered(placed.repartitionByRange(tasks, *by).sortWithinPartitions(*by), "mix")
    counts = mixed.groupBy("_part").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"),
                           F.sum("_n").over(Window.partitionBy()).alias("_total"))
    position = F.col("_before") + F.col("_place")
    # shard = floor(position * shards / total); its first position is ceil(shard * total / shards)
    out = (mixed.join(F.broadcast(before), F.col("_part") == F.col("_p"))     # one row per partition
           .withColumn("_at", position)
           .withColumn("shard", F.expr(f"(_at * {shards}) div _total").cast("int")))
    first = F.expr(f"(cast(shard as bigint) * _total + {shards - 1}) div {shards}")
    return out.select("doc_id", "size", "text_crc32", "source", "shard", (F.col("_at") - first).cast("long").alias("slot"), *also)


def write_shards(docs: DataFrame, path: str, shards: int = 40, seed: int = 0) -> None:
    """Write every row once, whole, one folder per shard, ordered by slot. Rows are numbered once
    in a written table and the assignment is joined on that number, so null ids and rows that
    share id and text stay themselves."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = keep(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    plan = _assigned(rows, shards, seed, "doc_id", "text", "source", [row]).select(row, "shard", "slot")
    (rows.join(plan, row).drop(row)
     .repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
