"""Union of differing schemas, global row index and batching."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.functions.expr import qcol
from recordlink.operators.dedup import _as_list


def union_all(frames: Sequence[DataFrame] | Mapping[str, DataFrame], tag: str | None = None) -> DataFrame:
    """Concatenate frames with different columns.

    A column whose type differs between frames is read as string everywhere
    (a type clash would otherwise fail at run time); missing columns are NULL.
    With a mapping and ``tag``, each row carries its frame's name.
    """
    items = list(frames.items()) if isinstance(frames, Mapping) else [(None, f) for f in frames]
    types: dict = {}
    for _, f in items:
        for fld in f.schema.fields:
            types.setdefault(fld.name, set()).add(fld.dataType.simpleString())
    clash = {n for n, ts in types.items() if len(ts) > 1}
    out = None
    for name, f in items:
        sel = [qcol(c).cast("string").alias(c) if c in clash else qcol(c) for c in f.columns]
        if tag and name is not None:
            sel.append(F.lit(name).alias(tag))
        g = f.select(*sel)
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out


def row_index(df: DataFrame, order_by, name: str = "row_index") -> DataFrame:
    """0-based position of each row in ``order_by`` order, without a global window.

    The frame is range-partitioned and sorted by ``order_by``; each row gets its
    rank inside its partition plus the number of rows in earlier partitions. The
    per-partition counts are one row per partition (a bounded broadcast). The
    sorted, id-tagged frame is checkpointed to the shared checkpoint folder so
    that both uses read identical partitions, even after an executor loss.
    """
    from recordlink.session import cut_lineage
    oc = _as_list(order_by)
    s = (df.repartitionByRange(*[qcol(c) for c in oc]).sortWithinPartitions(*[qcol(c) for c in oc])
         .withColumn("_rl_pid", F.spark_partition_id())
         .withColumn("_rl_mid", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    local = F.col("_rl_mid") - F.shiftleft(F.col("_rl_pid").cast("bigint"), 33)
    counts = s.groupBy("_rl_pid").agg(F.count(F.lit(1)).alias("_rl_n"))
    from pyspark.sql import Window
    offsets = counts.select("_rl_pid", (F.sum("_rl_n").over(Window.orderBy("_rl_pid"))
                                        - F.col("_rl_n")).alias("_rl_off"))
    j = s.join(F.broadcast(offsets), "_rl_pid")
    return j.withColumn(name, F.col("_rl_off") + local).drop("_rl_pid", "_rl_mid", "_rl_off")


def assign_batches(df: DataFrame, n: int, order_by, name: str = "batch") -> DataFrame:
    """Consecutive batches of ``n`` rows in ``order_by`` order."""
    if n <= 0:
        raise ValueError("batch size must be positive")
    r = row_index(df, order_by, name="_rl_rank")
    return r.withColumn(name, F.floor(F.col("_rl_rank") / F.lit(n)).cast("bigint")).drop("_rl_rank")
