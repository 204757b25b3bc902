"""End-to-end jobs a user runs (M1-M15): compositions of the operators with
their sinks. Everything up to the ``write_*`` call is one lazy plan; shared
intermediate results are persisted once where two outputs read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlink.operators import combine as C
from recordlink.operators import dedup as D
from recordlink.operators import outlets as O
from recordlink.operators import places as P
from recordlink.operators import quality as Q
from recordlink.sources import readers as R
from recordlink.sources import sinks as S


def master_combine(spark: SparkSession, registry_dir: str, account_dir: str, out: str,
                   fmt: str = "json", resolve: bool = True) -> dict:
    """M1/M3: every registry file + every account file (first row per key per
    source), combined by key, appended to ``out``. Returns row counts."""
    reg = R.read_dir(spark, registry_dir, fmt, order_by="_in_seq")
    acc = R.read_dir(spark, account_dir, fmt, order_by="_in_seq")
    combined = C.combine(reg, acc, order_by="_in_seq", resolve=resolve).persist()
    try:
        S.write_append(combined, out)
        stats = C.combine_stats(combined).first().asDict()
    finally:
        combined.unpersist()
    return stats


def merge_source(spark: SparkSession, src_dir: str, out: str, fmt: str = "json") -> None:
    """M2: all files of one source and format, first row per key, one output."""
    S.write_append(R.read_dir(spark, src_dir, fmt, order_by="_in_seq"), out)


def combine_files(spark: SparkSession, left_path: str, right_path: str, out: str) -> dict:
    """M4: two files (any supported format) combined, with coverage stats."""
    l, r = (R.read_placed(spark, p, "_in_seq") for p in (left_path, right_path))
    c = C.combine(l, r, order_by="_in_seq").persist()
    try:
        S.write_all(c, out)
        return C.combine_stats(c).first().asDict()
    finally:
        c.unpersist()


def clean_and_validate(df: DataFrame, out: str, required=()) -> dict:
    """M5: clean, standardise names, validate; write rows and return the summary."""
    from recordlink.operators.schema import standardize
    v = Q.validate(standardize(Q.clean(df)), required).persist()
    try:
        S.write_all(v.withColumn("errors", F.array_join("errors", "; ")), out)
        return Q.validation_summary(v).first().asDict()
    finally:
        v.unpersist()


def quality_view(df: DataFrame, key_field: str = "taxpayer_id", top: int = 15):
    """M6: dataset numbers (one row) and the most complete fields."""
    return Q.quality_report(df, key_field), Q.completeness(df, top=top)


def dedup_file(spark: SparkSession, path: str, out: str, strategy: str = "key",
               review_out: str | None = None) -> dict:
    """Load, flag duplicates, write uniques (and removed rows for
    review), return F2 stats."""
    df = R.read_placed(spark, path, "_in_seq")
    flagged = D.dedup(df, strategy, order_by="_in_seq").persist()
    try:
        S.write_all(D.unique(flagged).drop("_in_seq"), out)
        if review_out:
            S.write_all(D.duplicates(flagged).drop("_in_seq"), review_out)
        return D.dedup_stats(flagged).first().asDict()
    finally:
        flagged.unpersist()


def polish_outlets(source: DataFrame, deduped: DataFrame, out: str, merged: bool = True,
                   order_by="seq") -> dict:
    """M9: outlets from the raw source attached to the de-duplicated records;
    the outlet list is written beside the records. Returns F8 stats."""
    outl = O.collect_outlets(source, order_by=order_by)
    attached = (O.attach_merged_outlets(deduped, outl, order_by=order_by) if merged
                else O.attach_outlets(deduped, outl, order_by=order_by)).persist()
    try:
        S.write_all(attached, f"{out.rstrip('/')}/records")
        outl.write.mode("overwrite").parquet(f"{out.rstrip('/')}/outlets")
        return {r.metric: r.value for r in O.outlet_stats(source, attached).collect()}
    finally:
        attached.unpersist()


def validate_after_dedup(flagged: DataFrame, order_by="_in_seq", required=(), show: int = 5):
    """M8: validation summary of the unique rows and their first errors (H3)."""
    v = Q.validate(D.unique(flagged), required)
    return Q.validation_summary(v), Q.validation_errors(v, order_by, limit=100, with_index=False).limit(show)


def load_datasets(spark: SparkSession, paths: dict, out: str, limit_per_dataset: int | None = None,
                  fmt: str | None = None) -> None:
    """Several datasets appended to one output partitioned by dataset."""
    df = R.read_datasets(spark, paths, fmt, limit_per_dataset=limit_per_dataset, order_by="_in_seq")
    S.write_by_source(df.drop("_in_seq"), out, source_col="dataset_id", mode="append")


def places_two_step(records: DataFrame, search_responses: DataFrame, detail_responses: DataFrame,
                    out: str | None = None, order_by="seq"):
    """Search text -> place id (A13) -> found ids only (D5) -> details (A14);
    returns the details and their status counts (F13)."""
    from recordlink.operators.aggregate import status_counts
    matched = P.match_places(records, search_responses, order_by=order_by)
    found = matched.where(F.col("match_status") == "found")
    details = P.place_details(found, detail_responses, order_by=order_by)
    if out:
        S.write_all(details, out)
    return details, status_counts(details, "details_status")


def registry_download(spark: SparkSession, pages_dir: str, history: DataFrame, out: str,
                      limit: int | None = None) -> None:
    """Landed pages (A7) minus keys exported before (E10), appended."""
    from recordlink.operators.schema import resolve_key
    pages = R.read_pages(spark, pages_dir, limit).withColumn("_in_seq", F.struct("page", "pos"))
    hist = history.select(resolve_key(history).alias("taxpayer_id")).where(F.col("taxpayer_id").isNotNull())
    S.write_append(C.new_records(pages, hist, order_by="_in_seq"), out)


def final_combine(records: DataFrame, places: DataFrame, out: str) -> None:
    """Successful place details attached to the polished records."""
    S.write_all(P.attach_places(records, places), out)


def lookup_pipeline(records: DataFrame, fetch_fn, schema, cache: DataFrame | None = None,
                    max_parallel: int = 8) -> DataFrame:
    """Distinct keys of the records (F14) looked up once each (L2, E11); ``account_job`` is the whole job."""
    from recordlink.operators.aggregate import distinct_keys
    from recordlink.operators.schema import resolve_key
    from recordlink.streaming.lookup import lookup_batch
    keys = distinct_keys(records, resolve_key(records))
    return lookup_batch(keys, "taxpayer_id", fetch_fn, schema, max_parallel, cache=cache)


DEDUP_MODES = ("key", "exact", "hash", "fuzzy", "merge", "best")


def dedup_files(spark: SparkSession, paths: dict, out: str, mode: str = "key", fmt: str | None = None,
                key_fields=None) -> DataFrame:
    """M7 for all files: each named file is de-duplicated on its own, all of them in one job.

    ``mode`` is a strategy of ``dedup`` (the removed rows go to ``out/removed``), ``merge`` (one merged
    row per key, G5) or ``best`` (the most complete row per key, G6). The rows kept go to
    ``out/unique``; both folders are partitioned by ``file``. Returns per file the rows read, kept and
    removed; a file without rows is absent. The file's name is part of the key, so no row of one file
    meets another's.
    """
    from recordlink.functions.expr import stripped_key
    if mode not in DEDUP_MODES:
        raise ValueError(f"mode must be one of {DEDUP_MODES}")
    out = out.rstrip("/")
    rows = R.read_datasets(spark, paths, fmt, tag="file", order_by="_in_seq")
    if mode in ("merge", "best"):
        own = stripped_key(rows, key_fields or D.GROUP_KEY_FIELDS)
    elif mode in ("exact", "hash"):
        own = D.record_hash(rows, exclude=["_in_seq", "file"], recursive=mode == "hash")
    else:
        own = D.fuzzy_key(rows, key_fields) if mode == "fuzzy" else D.key_strategy_key(rows, key_fields)
    key = F.concat(F.col("file"), F.lit("\0"), own)        # NULL where the row has no key
    if mode == "merge":
        kept = D.merge_duplicates(rows, order_by="_in_seq", key=key)
    elif mode == "best":
        kept = D.best_by_completeness(rows, order_by="_in_seq", key=key)
    else:
        flagged = D.dedup(rows, order_by="_in_seq", key=key).persist()
        try:
            S.write_by_source(D.unique(flagged).drop("_in_seq"), f"{out}/unique", "file")
            S.write_by_source(D.duplicates(flagged).drop("_in_seq"), f"{out}/removed", "file")
        finally:
            flagged.unpersist()
    if mode in ("merge", "best"):
        S.write_by_source(kept.drop("_in_seq"), f"{out}/unique", "file")
    left = spark.read.schema("file string").parquet(f"{out}/unique").groupBy("file").agg(F.count(F.lit(1)).alias("unique_count"))
    read = rows.groupBy("file").agg(F.count(F.lit(1)).alias("original_count"))
    return read.join(left, "file", "left").select(
        "file", "original_count", "unique_count", (F.col("original_count") - F.col("unique_count")).alias("duplicate_count"))


def account_job(spark: SparkSession, sources: dict, out: str, fetch_detail, detail_schema, fetch_status=None,
                status_schema=None, cache_path: str | None = None, **how) -> DataFrame:
    """M12 for one file or all: the keys of the records, looked up, flattened and exported.

    ``sources`` names frames of records. Every distinct key of any of them (F14) is looked up once
    (L2): ``fetch_detail(key)`` gives a dict of ``detail_schema`` or None, ``fetch_status(key)`` a list of
    dicts of ``status_schema`` (or one dict, or None). Answers go to ``out/details`` and ``out/status``
    before anything reads them, so a call is made once; with ``cache_path`` details found by earlier
    jobs are not asked for again (E11). ``how`` goes to ``lookup_batch``.

    ``out/flat`` holds one flat row per key (C16), ``out/accounts``, partitioned by ``source``, one per
    source and key (B9); a key whose lookup failed has its ``error``. Returns the run summary (F12)
    over the distinct keys.
    """
    from pyspark.sql import types as T

    from recordlink.operators.aggregate import distinct_keys, processing_summary
    from recordlink.operators.batches import union_all
    from recordlink.operators.schema import resolve_key
    from recordlink.sources.landed import account_info
    from recordlink.streaming.lookup import append_to_cache, lookup_batch
    out, key = out.rstrip("/"), "taxpayer_id"
    union_all({n: distinct_keys(df, resolve_key(df)) for n, df in sources.items()}, tag="source") \
        .write.mode("overwrite").parquet(f"{out}/keys")
    keys = spark.read.parquet(f"{out}/keys")
    cache = spark.read.parquet(cache_path) if cache_path and R.path_exists(spark, cache_path) else None
    lookup_batch(keys, key, fetch_detail, detail_schema, cache=cache, **how).write.mode("overwrite").parquet(f"{out}/details")
    answers = spark.read.parquet(f"{out}/details")
    if cache_path:
        append_to_cache(answers, cache_path)
    fields = [f.name for f in detail_schema.fields]
    found = F.exists(F.array(*[F.col(n).isNotNull() for n in fields]), lambda x: x)
    details, failed, status = answers.where(found).select(key, *fields), answers.where("error is not null").select(key, "error"), None
    if fetch_status is not None:
        def listed(k):
            got = fetch_status(k)
            return {"records": [got] if isinstance(got, dict) else got}

        lists = T.StructType([T.StructField("records", T.ArrayType(status_schema))])
        lookup_batch(keys, key, listed, lists, **how).write.mode("overwrite").parquet(f"{out}/status")
        got = spark.read.parquet(f"{out}/status")
        failed = failed.unionByName(got.where("error is not null").select(key, "error"))
        status = got.select(key, F.posexplode("records").alias("seq", "_rl_r")).select(key, "seq", "_rl_r.*")
    account_info(keys.select(key), details, status, errors=failed).write.mode("overwrite").parquet(f"{out}/flat")
    flat = spark.read.parquet(f"{out}/flat")
    S.write_by_source(keys.join(flat, key), f"{out}/accounts", "source")
    return processing_summary(flat)


def batch_pipeline(spark: SparkSession, pages_dir: str, out: str, fetch_detail, detail_schema, limit: int | None = None,
                   resolve: bool = True, **how) -> dict:
    """Landed pages (A7), their cleaned keys (C8) looked up (M12), both sides exported in all
    formats (``out/registry``, ``out/account``; B3), then combined (E1, E2), de-duplicated by key (G1)
    and written to ``out/combined``. Returns the combine statistics (F1)."""
    out = out.rstrip("/")
    pages = R.read_pages(spark, pages_dir, limit)
    registry = pages.withColumn("_in_seq", F.struct("page", "pos")).drop("page", "pos")
    S.write_all(registry.drop("_in_seq"), f"{out}/registry")
    account_job(spark, {"registry": registry}, f"{out}/lookups", fetch_detail, detail_schema, **how)
    fields = [f.name for f in detail_schema.fields]
    accounts = (spark.read.parquet(f"{out}/lookups/flat").where("has_details")
                .select("taxpayer_id", *[F.col(f"detail_{n}").alias(n) for n in fields]))
    S.write_all(accounts, f"{out}/account")
    combined = C.combine(registry, accounts.withColumn("_in_seq", F.lit(0)), order_by="_in_seq", resolve=resolve).persist()
    try:
        kept = D.unique(D.dedup(combined, key_fields=["taxpayer_id"], order_by="taxpayer_id"))
        S.write_all(kept.drop(*[c for c in kept.columns if c.endswith("_in_seq")]), f"{out}/combined")
        return C.combine_stats(combined).first().asDict()
    finally:
        combined.unpersist()
