"""Key-driven combination and enrichment.

All joins here are equi-joins on one key. Each side is collapsed to one row per
key first (``max_by`` / ``min_by`` aggregate, partial before the shuffle), then
joined on the same key, so the aggregate's partitioning is reused by the join:
one exchange per side. Broadcast is left to AQE, which only converts a side whose
measured runtime size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.functions.expr import as_string, percentage, qcol, strip, truthy_of
from recordlink.operators.dedup import (FIRST, KEY, PLACE, _as_list, first_at_place, order_col, place_order,
                                         pick_per_key)
from recordlink.operators.schema import TAXPAYER_ID_FIELDS, normalize, prefix, rename_fields, resolve_key
from recordlink.operators.skew import salted_join

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------
NAME_FIELDS = ["name", "business_name", "taxpayer_name", "legal_name"]
ADDRESS_FIELDS = ["address", "street_address", "taxpayer_address"]
DATE_FIELDS = ["filing_date", "registration_date", "effective_date"]


def collapse(df: DataFrame, key: Column, order_by="seq", keep: str = "last",
             key_name: str = KEY) -> DataFrame:
    """One row per non-NULL key: the last (or first) by ``order_by``; the key is
    returned as ``key_name``."""
    return pick_per_key(df, key, order_col(order_by), keep_nulls=False,
                        pick="max" if keep == "last" else "min", key_out=key_name)


def _side(df: DataFrame, source: str, key_name: str, candidates, order_by, keep,
          synonyms=None) -> DataFrame:
    """Key on the raw record, normalise names, keep one row per key, prefix."""
    from recordlink.operators.schema import _positional, normalize_field_name
    p0, _, orig = _positional(df)   # names may differ only in case
    d = normalize(p0.withColumn(KEY, resolve_key(p0, candidates, names=orig)), synonyms,
                  keep=[KEY], names=orig)
    order = [normalize_field_name(c, synonyms) for c in _as_list(order_by)]
    d = pick_per_key(d, F.col(KEY), order_col(order), keep_nulls=False,
                     pick="max" if keep == "last" else "min", key_out=KEY)
    p = prefix(d, source, exclude=[KEY])
    return p.withColumnRenamed(KEY, key_name).withColumn(f"_in_{source}", F.lit(True))


def combine(left: DataFrame, right: DataFrame, left_source: str = "registry",
            right_source: str = "account", priority: str = "right", keep: str = "last",
            order_by="seq", key_name: str = "taxpayer_id",
            candidates: Sequence[str] = TAXPAYER_ID_FIELDS, resolve: bool = False,
            address_priority: str = "right", synonyms=None) -> DataFrame:
    """Combine two sources by cleaned key (E1; with ``resolve`` also E2).

    Per side: rows without a valid key are dropped, names are normalised and
    prefixed ``{source}_``, and the last row per key (by ``order_by``) is kept.
    Then a full outer join gives one row per key with ``has_{source}_data`` flags.
    ``data_source`` names the priority side when it has the key, else the other.
    """
    l = _side(left, left_source, key_name, candidates, order_by, keep, synonyms)
    r = _side(right, right_source, key_name, candidates, order_by, keep, synonyms)
    j = l.join(r, key_name, "full_outer")
    hl = F.coalesce(F.col(f"_in_{left_source}"), F.lit(False))
    hr = F.coalesce(F.col(f"_in_{right_source}"), F.lit(False))
    pri, oth = (right_source, left_source) if priority == "right" else (left_source, right_source)
    hp = hr if priority == "right" else hl
    lcols = [c for c in l.columns if c not in (key_name, f"_in_{left_source}")]
    rcols = [c for c in r.columns if c not in (key_name, f"_in_{right_source}")]
    out = j.select(F.col(key_name), hl.alias(f"has_{left_source}_data"),
                   hr.alias(f"has_{right_source}_data"),
                   *[qcol(c) for c in lcols], *[qcol(c) for c in rcols],
                   F.when(hp, F.lit(pri)).otherwise(F.lit(oth)).alias("data_source"))
    if resolve:
        out = resolve_fields(out, left_source, right_source, address_priority)
    return out


def resolve_fields(combined: DataFrame, left_source: str = "registry",
                   right_source: str = "account", address_priority: str = "right") -> DataFrame:
    """Resolved name / address / dates on a combined frame (E2, on prefixed columns).

    name: longest truthy of the name fields (left side first; ties to the first);
    address: first truthy address of the ``address_priority`` side, else the
    other side's, with ``resolved_address_source``; dates: the right side's value
    when it has the key (even if NULL), else the left side's.
    """
    cols = set(combined.columns)

    def names_for(src):
        from recordlink.operators.schema import normalize_field_name
        seen = []
        for f in NAME_FIELDS:
            for cand in (f"{src}_{f}", f"{src}_{normalize_field_name(f)}"):
                if cand in cols and cand not in seen:
                    seen.append(cand)
        return seen

    def addr_for(src):
        from recordlink.operators.schema import normalize_field_name
        seen = []
        for f in ADDRESS_FIELDS:
            for cand in (f"{src}_{f}", f"{src}_{normalize_field_name(f)}"):
                if cand in cols and cand not in seen:
                    seen.append(cand)
        return seen

    name_cols = names_for(left_source) + names_for(right_source)
    sel = [F.col("*")]
    if name_cols:
        cands = [F.when(truthy_of(combined, c),
                        F.struct(F.length(qcol(c).cast("string")).alias("l"),
                                 F.lit(-i).alias("i"), qcol(c).cast("string").alias("v")))
                 for i, c in enumerate(name_cols)]
        best = F.greatest(*cands) if len(cands) > 1 else cands[0]
        sel.append(best["v"].alias("resolved_business_name"))
    order = ([right_source, left_source] if address_priority == "right"
             else [left_source, right_source])
    addr_parts, src_parts = [], []
    for src in order:
        for c in addr_for(src):
            addr_parts.append(F.when(truthy_of(combined, c), qcol(c).cast("string")))
            src_parts.append(F.when(truthy_of(combined, c), F.lit(src)))
    if addr_parts:
        sel.append(F.coalesce(*addr_parts).alias("resolved_address"))
        sel.append(F.coalesce(*src_parts).alias("resolved_address_source"))
    from recordlink.operators.schema import normalize_field_name
    done = set()
    for f in DATE_FIELDS:
        nf = normalize_field_name(f)
        if nf in done:
            continue
        rc, lc = f"{right_source}_{nf}", f"{left_source}_{nf}"
        has_r = F.col(f"has_{right_source}_data")
        if rc in cols:
            other = qcol(lc) if lc in cols else F.lit(None)
            sel.append(F.when(has_r, qcol(rc)).otherwise(other).alias(f"resolved_{nf}"))
            done.add(nf)
        elif lc in cols:
            sel.append(qcol(lc).alias(f"resolved_{nf}"))
            done.add(nf)
    return combined.select(*sel)


def combine_with_mapping(left: DataFrame, right: DataFrame, field_map: dict, **kw) -> DataFrame:
    """Rename ``left`` by ``field_map`` and combine (C6). A mapped name missing
    from ``left`` creates no column."""
    return combine(rename_fields(left, field_map), right, **kw)


def combine_stats(combined: DataFrame, left_source: str = "registry",
                  right_source: str = "account") -> DataFrame:
    """Totals and coverage percentages of a combined frame, one pass (F1)."""
    hl, hr = F.col(f"has_{left_source}_data"), F.col(f"has_{right_source}_data")
    a = combined.agg(F.count(F.lit(1)).alias("total_records"),
                     F.count_if(hl).alias(f"with_{left_source}_data"),
                     F.count_if(hr).alias(f"with_{right_source}_data"),
                     F.count_if(hl & hr).alias("with_both_sources"),
                     F.count_if(hl & ~hr).alias(f"only_{left_source}"),
                     F.count_if(hr & ~hl).alias(f"only_{right_source}"))
    t = F.col("total_records")
    return a.select("*",
                    percentage(F.col(f"with_{left_source}_data"), t).alias(f"coverage_{left_source}"),
                    percentage(F.col(f"with_{right_source}_data"), t).alias(f"coverage_{right_source}"),
                    percentage(F.col("with_both_sources"), t).alias("coverage_both"))


def enrich(base: DataFrame, extra: DataFrame, on: str = "taxpayer_id",
           prefix_: str = "enriched_", order_by="seq", keep: str = "last",
           include_order: bool = False) -> DataFrame:
    """Left-join ``extra``'s columns onto ``base`` by ``str(on)``.

    The last ``extra`` row per join value wins; its columns (except ``on``) are
    added as ``{prefix_}{name}``. NULL join values never match.
    """
    order_cols = _as_list(order_by)
    k = as_string(qcol(on), extra.schema[on].dataType)
    ex = collapse(extra, k, order_by, keep=keep)
    keep_cols = [c for c in extra.columns if c != on and (include_order or c not in order_cols)]
    ex = ex.select(F.col(KEY).alias("_rl_ek"), *[qcol(c).alias(f"{prefix_}{c}") for c in keep_cols])
    b = base.withColumn("_rl_bk", as_string(qcol(on), base.schema[on].dataType)
                        if on in base.columns else F.lit(None).cast("string"))
    return salted_join(b, ex.withColumnRenamed("_rl_ek", "_rl_bk"), "_rl_bk", "left").drop("_rl_bk")


def attach_account(base: DataFrame, accounts: DataFrame, id_field: str = "taxpayer_id",
                   prefix_: str = "account_", detail_fields: Sequence[str] | None = None,
                   account_key: str = "taxpayer_id") -> DataFrame:
    """Left-join account lookups onto ``base`` by the stripped id.

    ``accounts`` is one row per key as built by ``account_info`` (flat detail
    columns, ``has_details``, ``has_ftas``, ``ftas_count``). Matched rows get
    ``{prefix_}{detail}``, ``{prefix_}has_ftas`` and ``{prefix_}ftas_count``;
    unmatched rows get NULLs there.
    """
    if detail_fields is None:
        detail_fields = [c for c in accounts.columns if c.startswith("detail_")]
    acc = accounts.select(F.col(account_key).cast("string").alias("_rl_ak"),
                          *[F.when(F.col("has_details"), qcol(c)).alias(
                              f"{prefix_}{c[len('detail_'):] if c.startswith('detail_') else c}")
                            for c in detail_fields],
                          F.col("has_ftas").alias(f"{prefix_}has_ftas"),
                          F.col("ftas_count").alias(f"{prefix_}ftas_count"))
    b = base.withColumn("_rl_bk", strip(as_string(qcol(id_field), base.schema[id_field].dataType)))
    return salted_join(b, acc.withColumnRenamed("_rl_ak", "_rl_bk"), "_rl_bk", "left").drop("_rl_bk")


# Parts of hot keys to a task in ``merge_outer``: enough that hashing deals them evenly.
PARTS_A_TASK = 16


def merge_outer(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                suffixes=("_x", "_y"), null_equal: bool = False, hot_rows: int | None = None) -> DataFrame:
    """Full outer many-to-many join with ``_x`` / ``_y`` on overlapping names.

    ``null_equal=True`` matches NULL keys to each other (pandas behaviour); it is
    off by default because NULL-to-NULL matching emits every pair of NULL-key rows.

    Spark never splits a full outer join's skewed partitions, so keys with more than
    ``hot_rows`` rows on a side (counted first, over the key columns only) change the plan:
    matched pairs come from an inner join in which a hot key is dealt into a grid of parts (left
    rows by one salt, right rows by the other), and unmatched rows from joins with the counted
    keys. Without a hot key it is one plain full outer join. The rows are the same either way.

    A row is copied once for each part of the other side, so a key gets no more parts than its
    share of all pairs and rows asks for (``PARTS_A_TASK`` to a task) and none of fewer than
    ``hot_rows`` rows: the copies grow with the root of the number of pairs, not with the pairs.
    """
    from recordlink.operators.skew import hot_rows_of, salted_join
    on = _as_list(on)
    overlap = (set(left.columns) & set(right.columns)) - set(on)
    rest = [c + suffixes[0] if c in overlap else c for c in left.columns if c not in on]
    rest_r = [c + suffixes[1] if c in overlap else c for c in right.columns if c not in on]

    def side(df, i):
        whole = F.struct(*[qcol(c) for c in on])
        if not null_equal:
            full = qcol(on[0]).isNotNull()
            for c in on[1:]:
                full = full & qcol(c).isNotNull()
            whole = F.when(full, whole)
        named = [qcol(c).alias(c + suffixes[i]) if c in overlap else qcol(c) for c in df.columns if c not in on]
        return df.select(*[qcol(c).alias(f"_rl_on{i}_{c}") for c in on], *named, whole.alias("_rl_k"))

    l, r = side(left, 0), side(right, 1)
    keys = {i: [F.col(f"_rl_on{i}_{c}").alias(c) for c in on] for i in (0, 1)}
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    counts = (l.select("_rl_k", one.alias("nl"), zero.alias("nr")).unionByName(r.select("_rl_k", zero.alias("nl"), one.alias("nr")))
              .where(F.col("_rl_k").isNotNull()).groupBy("_rl_k").agg(F.sum("nl").alias("nl"), F.sum("nr").alias("nr")))
    h = hot_rows_of(left, hot_rows)
    n_pairs = F.col("nl").cast("double") * F.col("nr")
    n_rows = (F.col("nl") + F.col("nr")).cast("double")
    most, pairs, rows = counts.agg(F.max(F.greatest("nl", "nr")), F.sum(n_pairs), F.sum(n_rows)).first()
    if (most or 0) <= h:
        r_plain = r.withColumnRenamed("_rl_k", "_rl_kr")
        j = l.join(r_plain, l["_rl_k"] == r_plain["_rl_kr"], "full_outer")
        return j.select(*[F.coalesce(f"_rl_on0_{c}", f"_rl_on1_{c}").alias(c) for c in on], *map(qcol, rest), *map(qcol, rest_r))
    tasks = max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    share = F.greatest(n_pairs / F.lit(max(pairs, 1.0)), n_rows / F.lit(max(rows, 1.0)))
    hot = (counts.where((F.col("nl") > 0) & (F.col("nr") > 0) & ((F.col("nl") > h) | (F.col("nr") > h)))
           .select("_rl_k", *_grid(F.col("nl"), F.col("nr"), F.ceil(share * (PARTS_A_TASK * tasks)), h)).where("_rl_nl > 1 or _rl_nr > 1"))

    def dealt(df, own, other):
        """Rows with a salt of their own; one copy for each salt of the other side."""
        n_own, n_other = (F.coalesce(f"_rl_{n}", F.lit(1)) for n in (own, other))
        return (df.where(F.col("_rl_k").isNotNull()).join(hot, "_rl_k", "left")
                .withColumn(f"_rl_s{own}", F.pmod(_row_hash(df), n_own).cast("int"))
                .withColumn(f"_rl_s{other}", F.explode(F.sequence(F.lit(0), n_other - 1))).drop("_rl_nl", "_rl_nr"))

    # Spark's size estimates do not see that the copies multiply a side's rows, so a side of a few MB
    # would be broadcast however large its copies are: the sides are always merged. Nor do they see the
    # pairs, so that small partitions would be put into one task however many pairs they make: the
    # number of tasks is given
    cell = ["_rl_k", "_rl_snl", "_rl_snr"]
    matched = (dealt(l, "nl", "nr").repartition(tasks, *cell).hint("merge").join(dealt(r, "nr", "nl").repartition(tasks, *cell).hint("merge"), cell)
               .select(*keys[0], *map(qcol, rest), *map(qcol, rest_r)))

    def unmatched(df, own, other, i):
        alone = counts.where(F.col(other) == 0)
        # NULL keys spread by their rows; they match nothing and all stay
        some = salted_join(df.where(F.col("_rl_k").isNotNull()), alone.select("_rl_k"), "_rl_k", "left_semi", hot_rows=h,
                           salt_cols=[c for c in df.columns if c != "_rl_k"], counts=counts, count_col=own)
        return some.unionByName(df.where(F.col("_rl_k").isNull())).select(*keys[i], *map(qcol, rest if i == 0 else rest_r))

    only_l, only_r = unmatched(l, "nl", "nr", 0), unmatched(r, "nr", "nl", 1)
    empty = [matched.schema[c] for c in matched.columns]
    return (matched.unionByName(only_l.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in empty if f.name not in only_l.columns]))
            .unionByName(only_r.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in empty if f.name not in only_r.columns])))


def _grid(nl: Column, nr: Column, parts: Column, h: int) -> list[Column]:
    """``_rl_nl``, ``_rl_nr``: how many parts either side of a key is dealt into, about ``parts`` in
    all, with the fewest copies (near-square parts) and at most one for each ``h`` rows of a side."""
    most_l, most_r = (F.ceil(n / F.lit(h)).cast("double") for n in (nl, nr))
    one = F.lit(1.0)
    first = F.least(most_l, F.greatest(one, F.sqrt(parts * nl / nr)))
    on_r = F.least(most_r, F.ceil(parts / first).cast("double"))
    on_l = F.least(most_l, F.greatest(one, F.ceil(parts / on_r).cast("double")))
    return [on_l.cast("int").alias("_rl_nl"), on_r.cast("int").alias("_rl_nr")]


def _row_hash(df: DataFrame) -> Column:
    from recordlink.operators.skew import _holds_map
    return F.xxhash64(*[qcol(c) for c in df.columns if not _holds_map(df.schema[c].dataType)])


def incremental_ids(df: DataFrame, existing: DataFrame, id_field: str = "taxpayer_id",
                    existing_field: str | None = None) -> DataFrame:
    """Rows whose truthy ``id_field`` is not in ``existing`` (E9). Rows without an
    id are dropped; repeats inside the batch are kept."""
    ef = existing_field or id_field
    ex = existing.select(as_string(qcol(ef), existing.schema[ef].dataType).alias("_rl_ik")).distinct()
    d = df.where(truthy_of(df, id_field)).withColumn(
        "_rl_ik", as_string(qcol(id_field), df.schema[id_field].dataType))
    return salted_join(d, ex, "_rl_ik", "left_anti").drop("_rl_ik")


def new_records(df: DataFrame, existing_keys: DataFrame, key: Column | None = None,
                order_by="seq", existing_key_col: str = "taxpayer_id",
                keep_null: bool = True, dedup_when_empty: bool = True) -> DataFrame:
    """Rows whose cleaned key was never exported before, first per key.

    Rows without a key are all kept (``keep_null``). ``dedup_when_empty=False``
    reproduces returning the input untouched when there is no history (costs one
    ``isEmpty`` probe).
    """
    k = key if key is not None else resolve_key(df)
    if not dedup_when_empty and existing_keys.isEmpty():
        return df
    # One aggregate over the batch's and the history's keys: a key seen before has
    # min(is_batch) 0 and gives no new row; any other names the place (order, content
    # hash) of its first batch row, picked by a join on (key, place) (no join on the
    # key alone, so a hot key is harmless).
    d = df.withColumn("_rl_nk", k).withColumn("_rl_ord", place_order(df, order_by))
    ord_type = d.schema["_rl_ord"].dataType
    batch = d.select("_rl_nk", F.lit(1).alias("_rl_b"), "_rl_ord")
    seen = existing_keys.select(qcol(existing_key_col).alias("_rl_nk"), F.lit(0).alias("_rl_b"),
                                F.lit(None).cast(ord_type).alias("_rl_ord"))
    firsts = (batch.unionByName(seen).where(F.col("_rl_nk").isNotNull())
              .groupBy("_rl_nk").agg(F.min("_rl_b").alias("_rl_b"), F.min("_rl_ord").alias("_rl_ord"))
              .where(F.col("_rl_b") == 1)
              .select(F.struct("_rl_nk", "_rl_ord").alias(PLACE), F.lit(True).alias(FIRST)))
    place = F.struct("_rl_nk", "_rl_ord").cast(firsts.schema[PLACE].dataType)
    keyed = d.where(F.col("_rl_nk").isNotNull()).withColumn(PLACE, place)
    out = (first_at_place(keyed.join(firsts, PLACE)).where(F.col(FIRST))
           .drop("_rl_nk", "_rl_ord", PLACE, FIRST))
    if keep_null:
        out = out.unionByName(d.where(F.col("_rl_nk").isNull()).drop("_rl_nk", "_rl_ord"))
    return out


def remaining(pending: DataFrame, completed: DataFrame, key: str = "taxpayer_id") -> DataFrame:
    """Pending work not yet completed."""
    return pending.join(completed.select(key).distinct(), key, "left_anti")


def cache_split(requests: DataFrame, cache: DataFrame, key: str = "taxpayer_id",
                status_col: str | None = None, cache_errors: bool = False) -> DataFrame:
    """Flag each request as a cache hit or miss (E11). With ``status_col`` and
    ``cache_errors=False`` only successful cached rows count as hits."""
    c = cache
    if status_col and not cache_errors and status_col in cache.columns:
        c = c.where(F.col(status_col).isin("success", "found"))
    hits = c.select(qcol(key).alias("_rl_ck")).distinct()
    return (requests.join(hits, requests[key] == hits["_rl_ck"], "left")
            .withColumn("from_cache", F.col("_rl_ck").isNotNull()).drop("_rl_ck"))


def match_keys(left: DataFrame, right: DataFrame, key: str = "taxpayer_id") -> DataFrame:
    """Inner join on the key."""
    return left.join(right, key, "inner")
