"""Group aggregates and status counts."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.functions.expr import percentage, qcol, truthy_of
from recordlink.operators.dedup import _as_list, order_col

# pandas aggregation name -> Spark aggregate (first / last skip NULLs, as pandas).
_SIMPLE = {
    "sum": F.sum, "mean": F.avg, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max,
    "nunique": F.count_distinct, "std": F.stddev_samp, "var": F.var_samp,
}


def _agg_expr(field: str, func: str, ordc: Column | None) -> Column:
    c = qcol(field)
    if func in _SIMPLE:
        return _SIMPLE[func](c)
    if func == "size":
        return F.count(F.lit(1))
    if func in ("first", "last"):
        if ordc is None:
            raise ValueError("first / last need order_by")
        o = F.when(c.isNotNull(), ordc)
        return F.min_by(c, o) if func == "first" else F.max_by(c, o)
    raise ValueError(f"unknown aggregation {func!r}")


def group_agg(df: DataFrame, group_by: str | Sequence[str], spec: Mapping[str, str | Sequence[str]],
              dropna: bool = True, order_by=None) -> DataFrame:
    """pandas-style ``groupby(...).agg({field: func})``.

    Output columns are named by field (``{field}_{func}`` when a field has several
    functions). NULL group keys are dropped unless ``dropna=False``. Partial
    aggregation runs before the shuffle for every function; ``nunique`` counts distinct
    values in two steps and ``median`` selects by counts (``group_medians``), so that no
    group's values are ever held in one buffer.
    """
    keys = _as_list(group_by)
    d = df
    if dropna:
        cond = None
        for k in keys:
            e = qcol(k).isNotNull()
            cond = e if cond is None else cond & e
        d = d.where(cond)
    ordc = order_col(order_by) if order_by is not None else None
    aggs, distinct = [], []
    for field, funcs in spec.items():
        fl = _as_list(funcs)
        for fn in fl:
            name = field if len(fl) == 1 else f"{field}_{fn}"
            if fn in ("nunique", "median"):
                distinct.append((fn, field, name))
            else:
                aggs.append(_agg_expr(field, fn, ordc).alias(name))
    if not distinct:
        return d.groupBy(*keys).agg(*aggs)
    # A distinct count next to other aggregates makes Spark expand every row once
    # per distinct column; instead count distinct values with a two-step
    # aggregate (both steps partial) and join the one-row-per-group results.
    out = d.groupBy(*keys).agg(*(aggs or [F.count(F.lit(1)).alias("_rl_n")]))
    for fn, field, name in distinct:
        if fn == "median":
            dc = group_medians(d, keys, field, name)
        else:
            dc = (d.select(*[qcol(k) for k in keys], qcol(field).alias("_rl_v")).distinct()
                  .groupBy(*keys).agg(F.count("_rl_v").alias(name)))
        cond = None
        for k in keys:
            e = out[k].eqNullSafe(dc[k])
            cond = e if cond is None else cond & e
        out = out.join(dc, cond, "left").select(out["*"], dc[name])
    out = out.drop("_rl_n")
    return out


def group_medians(df: DataFrame, group_by: str | Sequence[str], field: str, name: str = "median",
                  tasks: int | None = None) -> DataFrame:
    """Exact median of ``field`` per group, NULL values left out; a group without values is absent.

    Values are counted per (group, value), range-partitioned in that order into ``tasks`` parts
    (default: the session's shuffle width) and checkpointed there, which fixes the parts. Sums per
    (part, group) give every part the number of a group's values before it, running counts inside
    the part the ranks, and the one or two rows at the middle ranks are averaged. A group with any
    share of the rows is spread over as many parts as its distinct values fill.
    """
    from pyspark.sql import Window

    from recordlink.session import cut_lineage
    keys = _as_list(group_by)
    names = [f"_rl_g{i}" for i in range(len(keys))]
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # + 0.0 makes one value of the two zeros
    values = df.select(*[qcol(k).alias(g) for k, g in zip(keys, names)], (qcol(field).cast("double") + F.lit(0.0)).alias("_rl_v"))
    counts = values.where(F.col("_rl_v").isNotNull()).groupBy(*names, "_rl_v").agg(F.count(F.lit(1)).alias("_rl_c"))
    placed = cut_lineage(counts.repartitionByRange(n, *names, "_rl_v").withColumn("_rl_part", F.spark_partition_id()))
    sums = placed.groupBy(*names, "_rl_part").agg(F.sum("_rl_c").alias("_rl_s"))         # at most ``tasks`` rows a group
    over = Window.partitionBy(*names)
    starts = sums.select(*[F.col(g).alias(f"{g}_s") for g in names], F.col("_rl_part").alias("_rl_part_s"), F.sum("_rl_s").over(over).alias("_rl_n"),
                         (F.sum("_rl_s").over(over.orderBy("_rl_part")) - F.col("_rl_s")).alias("_rl_before"))
    inside = Window.partitionBy(*names, "_rl_part").orderBy("_rl_v")
    cond = F.col("_rl_part") == F.col("_rl_part_s")
    for g in names:
        cond = cond & F.col(g).eqNullSafe(F.col(f"{g}_s"))
    ranked = (placed.withColumn("_rl_to", F.sum("_rl_c").over(inside)).join(starts, cond)
              .withColumn("_rl_to", F.col("_rl_to") + F.col("_rl_before")).withColumn("_rl_from", F.col("_rl_to") - F.col("_rl_c") + 1))
    low, high = (F.floor((F.col("_rl_n") + i) / 2) for i in (1, 2))

    def holds(rank):
        return (F.col("_rl_from") <= rank) & (rank <= F.col("_rl_to"))

    middle = ranked.where(holds(low) | holds(high))
    return middle.groupBy(*names).agg(((F.max(F.when(holds(low), F.col("_rl_v"))) + F.max(F.when(holds(high), F.col("_rl_v")))) / 2).alias(name)).select(
        *[F.col(g).alias(k) for k, g in zip(keys, names)], name)


def status_counts(df: DataFrame, status_col: str, decimals: int = 6) -> DataFrame:
    """Rows per status value with their share of all rows.

    The total is a scalar subquery (one partial aggregate), so no window or
    single task sees all the groups, whatever the column's cardinality.
    """
    g = df.groupBy(qcol(status_col).alias(status_col)).agg(F.count(F.lit(1)).alias("count"))
    tot = df.agg(F.count(F.lit(1))).scalar()
    return g.withColumn("percentage", percentage(F.col("count"), tot, decimals))


def processing_summary(df: DataFrame) -> DataFrame:
    """Lookup run summary (F12): totals with details / status records / errors."""
    cols = set(df.columns)
    n = F.count(F.lit(1))
    aggs = [n.alias("total_records"),
            F.count_if(F.coalesce(F.col("has_details"), F.lit(False))).alias("with_details")
            if "has_details" in cols else F.lit(0).alias("with_details"),
            F.count_if(F.coalesce(F.col("has_ftas"), F.lit(False))).alias("with_ftas")
            if "has_ftas" in cols else F.lit(0).alias("with_ftas"),
            F.count_if(truthy_of(df, "error")).alias("errors")
            if "error" in cols else F.lit(0).alias("errors")]
    a = df.agg(*aggs)
    t = F.col("total_records")
    return a.select("*", *[percentage(F.col(c), t).alias(f"{c}_pct")
                           for c in ("with_details", "with_ftas", "errors")])


def distinct_keys(df: DataFrame, key: Column, name: str = "taxpayer_id") -> DataFrame:
    """Distinct non-NULL keys."""
    return df.select(key.alias(name)).where(F.col(name).isNotNull()).distinct()


def row_counts(**frames: DataFrame) -> DataFrame:
    """``(name, rows)`` per frame (F15, F16) as a union of one-row counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows")
             for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
