"""Search, ad-hoc query, top-N and sample operators.

Limits here are the feature (a top-k report or a per-group cap the user asks
for); Catalyst turns them into ``TakeOrderedAndProject`` or a
``WindowGroupLimit`` that prunes each task's rows before the shuffle.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlink.functions.expr import qcol
from recordlink.operators.dedup import _as_list


def contains_ci(c, value: str, wildcards: bool = False):
    """Case-insensitive containment of ``value`` (D1). With ``wildcards`` the
    value is read as a LIKE pattern (``%`` / ``_``), as the remote API did."""
    up = F.upper(c.cast("string"))
    if wildcards:
        return up.like(f"%{value.upper()}%")
    return F.contains(up, F.lit(value.upper()))


def search(df: DataFrame, column: str, value: str, wildcards: bool = False,
           limit: int | None = None, order_by="seq") -> DataFrame:
    """Rows whose ``column`` contains ``value`` (D1, D2); ``limit`` keeps the first
    N by ``order_by``. A frame without the column gives no rows."""
    if column not in df.columns:
        return df.limit(0)
    out = df.where(contains_ci(qcol(column), value, wildcards))
    if limit is not None:
        out = out.orderBy(*_as_list(order_by)).limit(limit)
    return out


def top_n(df: DataFrame, by: str | Sequence[str], n: int, order_by,
          rank_col: str | None = None) -> DataFrame:
    """First ``n`` rows per group of ``by`` in ``order_by`` order.

    ``row_number() <= n`` becomes WindowGroupLimit: each task keeps at most n rows
    per group before the shuffle, so a hot group ships n rows per task.
    """
    oc = [F.col(c) if isinstance(c, str) else c for c in _as_list(order_by)]
    w = Window.partitionBy(*_as_list(by)).orderBy(*oc)
    name = rank_col or "_rl_rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def search_many(frames: Mapping[str, DataFrame], column: str, value: str, per: int = 100,
                order_by="seq", tag: str = "dataset_id", wildcards: bool = False) -> DataFrame:
    """Search several datasets, first ``per`` hits of each (D3). Datasets without
    the column are skipped; datasets without hits are simply absent."""
    parts = []
    for name, df in frames.items():
        if column not in df.columns:
            continue
        parts.append(df.where(contains_ci(qcol(column), value, wildcards))
                     .withColumn(tag, F.lit(name)))
    if not parts:
        raise ValueError(f"no dataset has column {column!r}")
    from recordlink.operators.batches import union_all
    u = union_all(parts)
    return top_n(u, tag, per, [tag, *_as_list(order_by)])


def search_names(df: DataFrame, names: DataFrame, column: str, name_col: str = "name",
                 per: int = 10, order_by="seq") -> DataFrame:
    """For each requested name, its first ``per`` exact (case-insensitive) matches
    (D7); names without a match are absent."""
    from recordlink.operators.skew import salted_join
    n = names.select(F.upper(qcol(name_col)).alias("_rl_name"), qcol(name_col).alias("query_name")).distinct()
    d = df.withColumn("_rl_name", F.upper(qcol(column)))
    j = salted_join(d, n, "_rl_name", "inner").drop("_rl_name")
    return top_n(j, "query_name", per, _as_list(order_by))


def search_names_contains(df: DataFrame, names: DataFrame, column: str, name_col: str = "name",
                          per: int | None = 10, order_by="seq", q: int = 3) -> DataFrame:
    """For each requested name, its first ``per`` rows (all with ``per=None``) whose ``column``
    contains it, whatever the case (D7). Names are taken literally (``%`` and ``_`` too); a NULL or
    empty name finds nothing, and names without a match are absent.

    A q-gram index join: a name is filed under the rarest of its q-grams among the texts (a shorter
    name under itself), a text meets the names filed under one of its own grams, and containment is
    checked on what meets. Each row meets a name once at most, and only grams that file a name are
    shuffled.
    """
    def grams(c, size):
        """Distinct substrings of ``size`` characters."""
        last = F.char_length(c) - size + 1
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), last)),
                                            lambda i: F.when(last >= 1, F.substring(c, i, F.lit(size)))))

    n = (names.select(qcol(name_col).alias("query_name"), F.upper(qcol(name_col)).alias("_rl_name")).distinct()
         .where(F.char_length("_rl_name") > 0).withColumn("_rl_q", F.least(F.lit(q), F.char_length("_rl_name"))))
    filed = n.withColumn("_rl_gram", F.explode(F.when(F.col("_rl_q") == q, grams(F.col("_rl_name"), q)).otherwise(F.array("_rl_name"))))
    wanted = filed.select("_rl_gram").distinct()
    d = df.withColumn("_rl_text", F.upper(qcol(column).cast("string")))
    every = F.array_distinct(F.flatten(F.array(*[grams(F.col("_rl_text"), size) for size in range(1, q + 1)])))
    text_grams = (d.where(F.char_length("_rl_text") > 0).withColumn("_rl_gram", F.explode(every)).join(wanted, "_rl_gram", "left_semi"))
    common = text_grams.groupBy("_rl_gram").agg(F.count(F.lit(1)).alias("_rl_c"))
    rarest = (filed.join(common, "_rl_gram").groupBy("query_name", "_rl_name", "_rl_q")
              .agg(F.count(F.lit(1)).alias("_rl_met"), F.min_by("_rl_gram", F.struct("_rl_c", "_rl_gram")).alias("_rl_gram")))
    # a name with a gram that no text holds is found nowhere
    needed = F.when(F.col("_rl_q") == q, F.size(grams(F.col("_rl_name"), q))).otherwise(1)
    rarest = rarest.where(F.col("_rl_met") == needed).select("query_name", "_rl_name", "_rl_gram")
    # Spark's size estimates do not see that each text has many grams, so texts of a few MB would be
    # broadcast with all their grams: the sides are merged
    hits = text_grams.hint("merge").join(rarest, "_rl_gram").where(F.contains("_rl_text", "_rl_name")).drop("_rl_gram", "_rl_text", "_rl_name")
    return hits if per is None else top_n(hits, "query_name", per, _as_list(order_by))


def sort_expr(text: str):
    """``"expr [ASC|DESC] [NULLS FIRST|LAST]"`` -> a sort Column."""
    words = text.strip().split()
    nulls = None
    if len(words) >= 3 and words[-2].upper() == "NULLS" and words[-1].upper() in ("FIRST", "LAST"):
        nulls = words[-1].upper()
        words = words[:-2]
    desc = False
    if len(words) >= 2 and words[-1].upper() in ("ASC", "DESC"):
        desc = words[-1].upper() == "DESC"
        words = words[:-1]
    c = F.expr(" ".join(words))
    if desc:
        return c.desc_nulls_first() if nulls == "FIRST" else c.desc_nulls_last() if nulls else c.desc()
    return c.asc_nulls_last() if nulls == "LAST" else c.asc_nulls_first() if nulls else c.asc()


def query(df: DataFrame, where: str | None = None, select: Sequence[str] | str | None = None,
          order: Sequence[str] | str | None = None, limit: int | None = None,
          offset: int | None = None) -> DataFrame:
    """Filter / project / sort / page with SQL expression strings."""
    out = df
    if where:
        out = out.where(F.expr(where))
    if order:
        out = out.orderBy(*[sort_expr(o) for o in _as_list(order)])
    if select:
        out = out.selectExpr(*_as_list(select))
    if offset:
        out = out.offset(offset)
    if limit is not None:
        out = out.limit(limit)
    return out


def first_n(df: DataFrame, n: int = 5, order_by="seq", columns: int | None = None) -> DataFrame:
    """Preview: the first ``n`` rows by ``order_by`` and optionally the first
    ``columns`` columns (H3, H4)."""
    out = df.orderBy(*_as_list(order_by)).limit(n)
    return out.select(*[qcol(c) for c in df.columns[:columns]]) if columns else out
