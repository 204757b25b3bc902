"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the driver's
tables (whole tables, no row caps). Outputs are projected to scalar columns
with explicit aliases so that they compare by value with the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlink.operators import combine as C
from recordlink.plans.catalog import Catalog
from recordlink.plans.fixtures import fx_account, fx_contacts, fx_places, fx_registry, fx_status

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _cat(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, sf_dir)


# ---------------------------------------------------------------------------
# combine
# ---------------------------------------------------------------------------

def _combined(spark, sf_dir, **kw) -> DataFrame:
    cat = _cat(spark, sf_dir)
    return C.combine(fx_registry(cat), fx_account(cat), **kw)


@query
def combine_full(spark, sf_dir):
    c = _combined(spark, sf_dir)
    return c.select("taxpayer_id", "has_registry_data", "has_account_data", "data_source",
                    "registry_seq", "registry_taxpayer_id", "registry_business_name",
                    "registry_outlet_number", "registry_outlet_name",
                    "account_seq", "account_status", "account_entity_type", "account_balance",
                    "account_business_name", "account_registration_date")


@query
def combine_stats(spark, sf_dir):
    return C.combine_stats(_combined(spark, sf_dir)).select(
        "total_records", "with_registry_data", "with_account_data", "with_both_sources",
        "only_registry", "only_account",
        F.round("coverage_registry", 6).alias("coverage_registry"),
        F.round("coverage_account", 6).alias("coverage_account"),
        F.round("coverage_both", 6).alias("coverage_both"))


@query
def combine_resolved(spark, sf_dir):
    c = _combined(spark, sf_dir, resolve=True)
    return c.select("taxpayer_id", "resolved_business_name", "resolved_address",
                    "resolved_address_source", "resolved_registration_date")


@query
def combine_mapped(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    c = C.combine_with_mapping(fx_registry(cat), fx_account(cat),
                               {"taxpayer_city": "city", "taxpayer_state": "state_code",
                                "no_such_field": "ignored"})
    return c.select("taxpayer_id", "registry_city", "registry_state", "account_status")


# ---------------------------------------------------------------------------
# Enrichment and set differences
# ---------------------------------------------------------------------------

@query
def enrich_left(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    e = C.enrich(fx_account(cat), fx_places(cat), on="taxpayer_id")
    return e.select("seq", "taxpayer_id", "enriched_place_id", "enriched_details_status",
                    "enriched_name", "enriched_rating")


def _account_info(cat, ids, errors=None):
    from recordlink.sources.landed import account_info
    acc = fx_account(cat)
    return account_info(ids, details=acc.drop("seq"), status=fx_status(cat), errors=errors)


@query
def account_info(spark, sf_dir):
    from recordlink.operators.aggregate import distinct_keys
    from recordlink.operators.schema import resolve_key
    cat = _cat(spark, sf_dir)
    reg = fx_registry(cat)
    ids = distinct_keys(reg, resolve_key(reg))
    a = _account_info(cat, ids)
    return a.select("taxpayer_id", "has_details", "has_ftas", "ftas_count", "detail_status",
                    "detail_entity_type", "detail_balance", "ftas_right_to_transact",
                    "ftas_report_year")


@query
def account_enrich(spark, sf_dir):
    from recordlink.functions.expr import stripped_key
    cat = _cat(spark, sf_dir)
    base = fx_contacts(cat)
    ids = base.select(stripped_key(base, ["taxpayer_id"]).alias("taxpayer_id")).where(
        F.col("taxpayer_id").isNotNull()).distinct()
    acc = _account_info(cat, ids)
    e = C.attach_account(base, acc, id_field="taxpayer_id",
                         detail_fields=["detail_status", "detail_entity_type"])
    return e.select("seq", "taxpayer_id", "account_status", "account_entity_type",
                    "account_has_ftas", "account_ftas_count")


@query
def places_attach(spark, sf_dir):
    from recordlink.operators.places import attach_places
    cat = _cat(spark, sf_dir)
    e = attach_places(fx_account(cat), fx_places(cat))
    return e.select("seq", "taxpayer_id", "google_name", "google_rating", "google_website",
                    "google_user_ratings_total", "google_place_id", "google_places_enriched")


@query
def merge_outer_m2m(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    left = cat.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey",
                             F.col("o_orderstatus").alias("status"),
                             F.col("o_totalprice").alias("amount"))
    right = cat.customer.select(F.col("c_custkey").alias("custkey"),
                                F.col("c_mktsegment").alias("status"),
                                F.col("c_acctbal").alias("amount"), "c_name")
    return C.merge_outer(left, right, "custkey")


def _split_registry(cat):
    reg = fx_registry(cat)
    old = F.col("outlet_permit_issue_date") < "1998-01-01"
    return reg.where(old), reg.where(~old | F.col("outlet_permit_issue_date").isNull())


@query
def new_records(spark, sf_dir):
    from recordlink.operators.aggregate import distinct_keys
    from recordlink.operators.schema import resolve_key
    cat = _cat(spark, sf_dir)
    existing, batch = _split_registry(cat)
    ex = distinct_keys(existing, resolve_key(existing))
    out = C.new_records(batch.withColumn("taxpayer_id", resolve_key(batch)), ex,
                        key=F.col("taxpayer_id"))
    return out.select("seq", "taxpayer_number", "taxpayer_id")


@query
def incremental_ids(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    existing, batch = _split_registry(cat)
    return C.incremental_ids(batch, existing, id_field="taxpayer_number").select(
        "seq", "taxpayer_number")


@query
def cache_split(spark, sf_dir):
    from recordlink.operators.aggregate import distinct_keys
    from recordlink.operators.schema import resolve_key
    cat = _cat(spark, sf_dir)
    reg = fx_registry(cat)
    req = distinct_keys(reg, resolve_key(reg))
    return C.cache_split(req, fx_places(cat), status_col="details_status").select(
        "taxpayer_id", "from_cache")


@query
def remaining_work(spark, sf_dir):
    from recordlink.operators.aggregate import distinct_keys
    from recordlink.operators.schema import resolve_key
    cat = _cat(spark, sf_dir)
    reg = fx_registry(cat)
    pending = distinct_keys(reg, resolve_key(reg))
    done = fx_account(cat).select("taxpayer_id")
    return C.remaining(pending, done)


# ---------------------------------------------------------------------------
# G*: deduplication
# ---------------------------------------------------------------------------

def _dedup_key_flagged(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    return D.dedup(fx_registry(cat), "key", with_key="dedup_key")


@query
def dedup_key(spark, sf_dir):
    return _dedup_key_flagged(spark, sf_dir).select("seq", "taxpayer_number", "dedup_key",
                                                     "is_duplicate")


@query
def dedup_stats(spark, sf_dir):
    from recordlink.operators import dedup as D
    s = D.dedup_stats(_dedup_key_flagged(spark, sf_dir))
    return s.select("original_count", "unique_count", "duplicate_count",
                    F.round("deduplication_rate", 6).alias("deduplication_rate"),
                    F.round("reduction_percentage", 6).alias("reduction_percentage"))


@query
def dedup_nullkeys_drop(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    f = D.dedup(fx_registry(cat), "key", null_keys="drop")
    return D.unique(f).select("seq", "taxpayer_number")


@query
def dedup_duplicates(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    return D.detect_duplicates(fx_contacts(cat), "taxpayer_id").select("seq", "taxpayer_id")


@query
def dedup_exact(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    docs = cat.documents.select(F.col("doc_id").alias("seq"), "text", "lang")
    return D.dedup(docs, "exact").select("seq", "lang", "is_duplicate")


@query
def dedup_hash(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    docs = cat.documents.select(F.col("doc_id").alias("seq"), "text", "n_chars")
    return D.unique(D.dedup(docs, "hash")).select("seq", "n_chars")


@query
def dedup_fuzzy(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    return D.dedup(fx_contacts(cat), "fuzzy", with_key="fuzzy_key").select(
        "seq", "fuzzy_key", "is_duplicate")


@query
def dedup_merge(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    m = D.merge_duplicates(fx_registry(cat))
    return m.select("seq", "taxpayer_number", "taxpayer_name", "taxpayer_address", "outlet_number",
                    "outlet_name", "outlet_city", "outlet_permit_issue_date", "_merged_from_count")


@query
def dedup_best(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    return D.best_by_completeness(fx_registry(cat)).select("seq", "taxpayer_number",
                                                            "completeness_score")


@query
def duplicate_groups(spark, sf_dir):
    from recordlink.operators import dedup as D
    cat = _cat(spark, sf_dir)
    return D.duplicate_groups(fx_registry(cat)).select("group_key", "seq", "group_size")


# ---------------------------------------------------------------------------
# Outlets
# ---------------------------------------------------------------------------

_OUT_COLS = ["seq", "taxpayer_number", "outlet_number", "outlet_name", "outlet_city",
             "outlet_permit_issue_date", "outlet_count", "outlets_attached"]


def _outlet_inputs(spark, sf_dir):
    from recordlink.operators import dedup as D
    from recordlink.operators.outlets import collect_outlets
    cat = _cat(spark, sf_dir)
    reg = fx_registry(cat)
    base = D.unique(D.dedup(reg, "key"))
    return reg, base, collect_outlets(reg)


@query
def outlets_first(spark, sf_dir):
    from recordlink.operators.outlets import attach_outlets
    _, base, outl = _outlet_inputs(spark, sf_dir)
    return attach_outlets(base, outl, base_unique=True).select(*_OUT_COLS)


@query
def outlets_merged(spark, sf_dir):
    from recordlink.operators.outlets import attach_merged_outlets
    _, base, outl = _outlet_inputs(spark, sf_dir)
    return attach_merged_outlets(base, outl, base_unique=True).select(*_OUT_COLS)


@query
def outlet_stats(spark, sf_dir):
    from recordlink.operators.outlets import attach_outlets, outlet_stats as stats
    reg, base, outl = _outlet_inputs(spark, sf_dir)
    return stats(reg, attach_outlets(base, outl, base_unique=True))


# ---------------------------------------------------------------------------
# Quality
# ---------------------------------------------------------------------------

@query
def clean_contacts(spark, sf_dir):
    from recordlink.operators.quality import clean
    return clean(fx_contacts(_cat(spark, sf_dir)))


def _validated(spark, sf_dir):
    from recordlink.operators.quality import validate
    return validate(fx_contacts(_cat(spark, sf_dir)), required=["business_name", "phone"])


@query
def validate_contacts(spark, sf_dir):
    v = _validated(spark, sf_dir)
    return v.select("seq", F.array_join("errors", "; ").alias("error_text"), "is_valid")


@query
def validation_errors(spark, sf_dir):
    from recordlink.operators.quality import validation_errors as ve
    e = ve(_validated(spark, sf_dir))
    return e.select("seq", "record_index", F.array_join("errors", "; ").alias("error_text"))


@query
def validation_summary(spark, sf_dir):
    from recordlink.operators.quality import validation_summary as vs
    s = vs(_validated(spark, sf_dir))
    return s.select("total_records", "valid_records", "invalid_records",
                    F.round("validation_rate", 6).alias("validation_rate"))


@query
def quality_report(spark, sf_dir):
    from recordlink.operators.quality import quality_report as qr
    r = qr(fx_contacts(_cat(spark, sf_dir)), key_field="taxpayer_id")
    return r.select("total_records", "duplicate_count",
                    F.round("duplicate_rate", 6).alias("duplicate_rate"),
                    "valid_records", "invalid_records",
                    F.round("validation_rate", 6).alias("validation_rate"))


@query
def completeness(spark, sf_dir):
    from recordlink.operators.quality import completeness as comp
    c = comp(fx_contacts(_cat(spark, sf_dir)), exclude=["seq"])
    return c.select("field", "pos", "filled", F.round("completeness", 6).alias("completeness"))


@query
def completeness_top(spark, sf_dir):
    from recordlink.operators.quality import completeness as comp
    c = comp(fx_registry(_cat(spark, sf_dir)), exclude=["seq"], top=5)
    return c.select("field", "pos", F.round("completeness", 6).alias("completeness"))


@query
def normalize_collide(spark, sf_dir):
    from recordlink.operators.schema import normalize
    c = fx_contacts(_cat(spark, sf_dir))
    k = F.col("seq")
    c = c.select("*",
                 F.when(k % 2 == 0, F.lit("")).otherwise(F.concat(F.col("zip"), F.lit("X")))
                 .alias("zipcode"),
                 F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("555-0100"))
                 .alias("Telephone"))
    return normalize(c).select("seq", "taxpayer_id", "business_name", "zip_code", "email", "phone")


@query
def standardize_fields(spark, sf_dir):
    from recordlink.operators.schema import standardize
    s = standardize(fx_registry(_cat(spark, sf_dir)))
    return s.select("seq", "taxpayer_id", "business_name", "zip", "taxpayer_city")


# ---------------------------------------------------------------------------
# Search / top-k / ad-hoc query / aggregates
# ---------------------------------------------------------------------------

@query
def search_contains(spark, sf_dir):
    from recordlink.operators.search import search
    cat = _cat(spark, sf_dir)
    cust = cat.customer.select(F.col("c_custkey").alias("seq"), "c_name", "c_mktsegment")
    return search(cust, "c_name", "r#00000001").select("seq", "c_name")


@query
def search_many(spark, sf_dir):
    from recordlink.operators.search import search_many as sm
    cat = _cat(spark, sf_dir)
    frames = {
        "customer": cat.customer.select(F.col("c_custkey").alias("seq"), F.col("c_name").alias("name")),
        "supplier": cat.supplier.select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("name")),
        "part": cat.part.select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("name")),
        "nation": cat.nation.select(F.col("n_nationkey").cast("bigint").alias("seq"),
                                    F.col("n_name").alias("nation_name")),
    }
    return sm(frames, "name", "er#0000000", per=100).select("dataset_id", "seq", "name")


@query
def topn_per_group(spark, sf_dir):
    from recordlink.operators.search import top_n
    cat = _cat(spark, sf_dir)
    p = cat.part.select("p_partkey", "p_brand", "p_retailprice")
    t = top_n(p, "p_brand", 3, [F.desc("p_retailprice"), F.asc("p_partkey")], rank_col="rank")
    return t.withColumn("rank", F.col("rank").cast("bigint"))


@query
def soql_like(spark, sf_dir):
    from recordlink.operators.search import query as q
    cat = _cat(spark, sf_dir)
    return q(cat.lineitem, where="l_quantity > 45 AND l_returnflag = 'R'",
             select=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
             order=["l_extendedprice DESC", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
             limit=50, offset=10)


@query
def agg_dropna(spark, sf_dir):
    from recordlink.operators.aggregate import group_agg
    cat = _cat(spark, sf_dir)
    li = cat.lineitem.select(
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .otherwise(F.col("l_returnflag")).alias("flag"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount")
    g = group_agg(li, "flag", {"l_quantity": ["sum", "mean", "min", "max", "std", "var", "median"],
                               "l_partkey": "nunique", "l_suppkey": ["first", "last"],
                               "l_discount": "size"},
                  order_by=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return g.select("flag", "l_quantity_sum", "l_quantity_mean", "l_quantity_min", "l_quantity_max",
                    F.round("l_quantity_std", 6).alias("l_quantity_std"),
                    F.round("l_quantity_var", 6).alias("l_quantity_var"),
                    "l_quantity_median", "l_partkey", "l_suppkey_first", "l_suppkey_last",
                    "l_discount")


@query
def key_extract(spark, sf_dir):
    from recordlink.operators.aggregate import distinct_keys
    from recordlink.operators.schema import resolve_key
    reg = fx_registry(_cat(spark, sf_dir))
    return distinct_keys(reg, resolve_key(reg))


@query
def status_counts(spark, sf_dir):
    from recordlink.operators.aggregate import status_counts as sc
    return sc(fx_places(_cat(spark, sf_dir)), "details_status")


@query
def union_schemas(spark, sf_dir):
    from recordlink.operators.batches import union_all
    cat = _cat(spark, sf_dir)
    frames = {
        "customer": cat.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                        F.col("c_acctbal").alias("balance"),
                                        F.col("c_mktsegment").alias("segment"),
                                        F.col("c_nationkey").alias("nationkey")),
        "supplier": cat.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                        F.col("s_acctbal").alias("balance"),
                                        F.col("s_nationkey").cast("string").alias("nationkey")),
    }
    return union_all(frames, tag="dataset_id")


@query
def assign_batches(spark, sf_dir):
    from recordlink.operators.batches import assign_batches as ab
    cat = _cat(spark, sf_dir)
    return ab(cat.customer.select("c_custkey", "c_name"), 100, "c_custkey")


# ---------------------------------------------------------------------------
# Places, nested records, text extraction
# ---------------------------------------------------------------------------

@query
def search_query(spark, sf_dir):
    from recordlink.operators.places import search_query as sq
    reg = fx_registry(_cat(spark, sf_dir))
    return reg.select("seq", sq(reg).alias("search_query"))


def _place_responses(cat):
    k = F.col("c_custkey")
    levels = F.array(*[F.lit(x) for x in ["PRICE_LEVEL_FREE", "PRICE_LEVEL_INEXPENSIVE",
                                           "PRICE_LEVEL_MODERATE", "PRICE_LEVEL_EXPENSIVE",
                                           "PRICE_LEVEL_VERY_EXPENSIVE", "PRICE_LEVEL_UNSPECIFIED"]])
    return cat.customer.select(
        k.alias("seq"),
        F.concat(F.lit("P"), k.cast("string")).alias("place_id"),
        F.struct(F.col("c_name").alias("text"), F.lit("en").alias("languageCode")).alias("displayName"),
        F.concat(k.cast("string"), F.lit(" Main St")).alias("formattedAddress"),
        ((k % 50).cast("double") / 10).alias("rating"),
        (k % 1000).cast("int").alias("userRatingCount"),
        F.struct((k.cast("double") / 1000).alias("latitude"),
                 (-k.cast("double") / 1000).alias("longitude")).alias("location"),
        F.element_at(levels, (k % 6 + 1).cast("int")).alias("priceLevel"),
    )


@query
def places_transform(spark, sf_dir):
    from recordlink.operators.places import transform_place
    from recordlink.operators.schema import flatten
    t = transform_place(_place_responses(_cat(spark, sf_dir)), keep=["place_id"])
    return flatten(t)


@query
def place_details(spark, sf_dir):
    from recordlink.operators.places import place_details as pd
    cat = _cat(spark, sf_dir)
    req = fx_places(cat).select("taxpayer_id", "place_id")
    # details of accounts in arrears were landed under another id (their lookups fail)
    arrears = cat.customer.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("place_id"),
                                  (F.col("c_acctbal") < 0).alias("_behind"))
    resp = _place_responses(cat).join(arrears, "place_id").withColumn(
        "place_id", F.when(F.col("_behind"), F.regexp_replace("place_id", "^P", "Q")).otherwise(F.col("place_id"))).drop("_behind")
    d = pd(req, resp)
    return d.select("taxpayer_id", "place_id", "details_status", "name", "price_level",
                    F.col("geometry.location.lat").alias("lat"))


@query
def flatten_nested(spark, sf_dir):
    from recordlink.operators.schema import flatten
    c = _cat(spark, sf_dir).customer
    nested = c.select(F.col("c_custkey").alias("id"),
                      F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                               F.struct(F.col("c_acctbal").alias("amount")).alias("balance"))
                      .alias("info"))
    return flatten(nested)


def _extract(spark, sf_dir, kind):
    from recordlink.functions.text import extract
    docs = _cat(spark, sf_dir).documents
    return extract(docs, "text", kind, keep=["doc_id"])


@query
def extract_emails(spark, sf_dir):
    return _extract(spark, sf_dir, "emails")


@query
def extract_numbers(spark, sf_dir):
    return _extract(spark, sf_dir, "numbers")


@query
def extract_urls(spark, sf_dir):
    """URLs in a sentence that holds each page's address twice and its image (the page bodies
    hold only relative links)."""
    from recordlink.functions.text import extract
    said = F.concat(F.lit("see "), F.col("url"), F.lit(" or <"), F.col("url"), F.lit("/a%20b?x=1> but not ftp://"),
                    F.col("url"), F.lit("#end"))
    pages = _cat(spark, sf_dir).pages.select("page_id", said.alias("said"))
    return extract(pages, "said", "urls", keep=["page_id"])


# ---------------------------------------------------------------------------
# Sources, sinks, streaming and user lookups. These write derived data to a
# fresh folder under the session's shared checkpoint folder and read it back.
# ---------------------------------------------------------------------------

def _scratch(spark, name):
    from recordlink.session import scratch_path
    return scratch_path(spark, name)


@query
def json_roundtrip(spark, sf_dir):
    """B1 write, A5 folder read (first row per cleaned key; unreadable records skipped)."""
    from recordlink.sources.readers import read_dir
    from recordlink.sources.sinks import write_json
    path = _scratch(spark, "json")
    write_json(fx_account(_cat(spark, sf_dir)).repartition(4), path)
    back = read_dir(spark, path, "jsonl", order_by="_in_seq")
    return back.select("seq", "taxpayer_id", "status", "balance")


@query
def csv_roundtrip(spark, sf_dir):
    """B2 write (sorted header), A3 read: every value comes back as text."""
    from recordlink.sources.readers import read_auto
    from recordlink.sources.sinks import write_csv
    path = _scratch(spark, "csv")
    write_csv(fx_contacts(_cat(spark, sf_dir)), path)
    back = read_auto(spark, path, fmt="csv")
    return back.select("seq", "taxpayer_id", "zip", "email", "phone")


@query
def table_manifest(spark, sf_dir):
    """B5 manifest, B6 verification, B8 fingerprint of the written table."""
    from recordlink.sources.sinks import verify_manifest, write_manifest
    path = _scratch(spark, "manifest")
    _cat(spark, sf_dir).customer.write.parquet(path)
    write_manifest(spark, path, glob="*.parquet")
    v = verify_manifest(spark, path, glob="*.parquet")
    # the number of files is the writer's choice; every one must be there and unchanged
    return v.agg(F.bool_and(F.col("status") == "verified").alias("all_verified"),
                 (F.count(F.lit(1)) > 0).alias("any_files"))


@query
def table_fingerprint(spark, sf_dir):
    """The fingerprint of a table equals that of its written and re-read copy in another
    order, and differs from that of an altered one."""
    from recordlink.sources.sinks import fingerprint
    table = _cat(spark, sf_dir).customer
    path = _scratch(spark, "fingerprint")
    table.repartition(3, "c_nationkey").write.parquet(path)
    other = table.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    a, b, c = fingerprint(table), fingerprint(spark.read.parquet(path)), fingerprint(other)
    tagged = (a.withColumn("t", F.lit("a")).unionByName(b.withColumn("t", F.lit("b")))
              .unionByName(c.withColumn("t", F.lit("c"))))
    of = {t: F.max(F.when(F.col("t") == t, F.struct("rows", "hash_sum", "hash_xor"))) for t in "abc"}
    return tagged.agg(F.max("rows").alias("rows"), (of["a"] == of["b"]).alias("copy_equal"),
                      (of["a"] == of["c"]).alias("altered_equal"))


@query
def json_lines_as_json(spark, sf_dir):
    """A1 / B1: JSON Lines output read back under the plain ``json`` format, every row."""
    from recordlink.sources.readers import read_auto
    from recordlink.sources.sinks import write_json
    path = _scratch(spark, "json-lines")
    write_json(_cat(spark, sf_dir).customer.select("c_custkey", "c_name", "c_mktsegment"), path)
    return read_auto(spark, path, fmt="json").select("c_custkey", "c_name", "c_mktsegment")


@query
def csv_text_roundtrip(spark, sf_dir):
    """A3 / B2: whole texts with quotes, commas and newlines survive a CSV file."""
    from recordlink.sources.readers import read_auto
    from recordlink.sources.sinks import write_csv
    path = _scratch(spark, "csv-text")
    quoted = F.concat(F.lit('said "'), F.col("text"), F.lit('", twice'))
    write_csv(_cat(spark, sf_dir).documents.select("doc_id", quoted.alias("text")), path)
    return read_auto(spark, path, fmt="csv").select("doc_id", F.md5("text").alias("text_md5"))


@query
def dedup_null_order(spark, sf_dir):
    """G1 / A5: a third of the order values are NULL and others repeat; each key keeps one row."""
    from recordlink.operators import dedup as D
    o = _cat(spark, sf_dir).orders.select(
        "o_custkey", F.when(F.col("o_orderkey") % 3 != 0, F.floor(F.col("o_orderkey") / 50)).alias("seq"), "o_orderkey")
    return D.unique(D.flag_first(o, F.col("o_custkey"), "seq")).select("o_custkey", "seq")


@query
def json_bad_first_line(spark, sf_dir):
    """A1 / A5: JSON Lines files whose first line is cut short lose that line only."""
    from recordlink.sources.readers import read_auto
    path = _scratch(spark, "json-cut")
    o = _cat(spark, sf_dir).orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 4).alias("part"))
    firsts = o.groupBy("part").agg(F.min("o_orderkey").alias("first"))
    line = F.to_json(F.struct("o_orderkey", "o_custkey"))
    cut = F.when(F.col("o_orderkey") == F.col("first"), F.expr("substring(line, 1, length(line) - 5)")).otherwise(F.col("line"))
    (o.withColumn("line", line).join(F.broadcast(firsts), "part").withColumn("value", cut)     # four rows
     .repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "value")
     .write.partitionBy("part").text(path))
    back = read_auto(spark, path, fmt="json", schema="o_orderkey long, o_custkey long, _corrupt_record string")
    return back.where(F.col("_corrupt_record").isNull()).select("o_orderkey", "o_custkey")


def _ragged(spark, sf_dir):
    """Orders as JSON records whose ``amount`` is an object, a number or a text; read back as VARIANT."""
    from recordlink.sources.ragged import read_records
    path = _scratch(spark, "ragged")
    k, c = F.col("o_orderkey").alias("id"), F.col("o_custkey")
    shapes = [F.to_json(F.struct(k, F.struct(c.alias("value"), F.lit("USD").alias("unit")).alias("amount"))),
              F.to_json(F.struct(k, c.alias("amount"))),
              F.to_json(F.struct(k, F.lit("n/a").alias("amount"), F.array(F.lit("x")).alias("tags")))]
    shape = F.when(F.col("o_orderkey") % 3 == 0, shapes[0]).when(F.col("o_orderkey") % 3 == 1, shapes[1]).otherwise(shapes[2])
    _cat(spark, sf_dir).orders.select(shape.alias("value")).write.text(path)
    return read_records(spark, path)


@query
def ragged_records(spark, sf_dir):
    """Fields of records whose shapes differ, kept whole as VARIANT."""
    from recordlink.sources.ragged import get_path, kind_of
    return _ragged(spark, sf_dir).select(
        get_path("record", "$.id", "bigint").alias("id"), kind_of(F.try_variant_get("record", "$.amount", "variant")).alias("kind"),
        F.coalesce(get_path("record", "$.amount.value", "bigint"), get_path("record", "$.amount", "bigint", -1)).alias("amount"),
        get_path("record", "$.tags[0]", "string", "none").alias("tag"))


@query
def ragged_paths(spark, sf_dir):
    """A15 on ragged records: kinds per path."""
    from recordlink.sources.ragged import path_types
    return path_types(_ragged(spark, sf_dir))


@query
def ragged_shredded(spark, sf_dir):
    """A1: typed columns for every path and kind that a fifth of the records have."""
    from recordlink.sources.ragged import shred
    return shred(_ragged(spark, sf_dir), min_share=0.2).drop("record", "_corrupt_record")


@query
def stream_replay(spark, sf_dir):
    """K1 / K5: the last batch of a stream is replayed (its commit is removed); the sink holds the
    same rows as after the first run."""
    from recordlink.streaming.incremental import read_ingested, stream_ingest as ingest
    c = _cat(spark, sf_dir).orders.select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("taxpayer_id"))
    src, dst, ck = (_scratch(spark, f"replay-{x}") for x in ("src", "dst", "ckpt"))
    for drop in (1, 2):
        half = c.where(F.col("seq") % 2 == drop - 1)
        half.write.json(f"{src}/drop={drop}")
        ingest(spark, src, dst, ck, c.schema, key_fn=lambda d: F.col("taxpayer_id"))
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{ck}/commits")
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, True)
    ingest(spark, src, dst, ck, c.schema, key_fn=lambda d: F.col("taxpayer_id"))
    return read_ingested(spark, dst).select("seq", "taxpayer_id")


def _two_runs(spark, sf_dir, name):
    """Even orders by one run, odd ones by a run with a checkpoint of its own into the same target,
    whose last batch is then replayed."""
    from recordlink.streaming.incremental import stream_ingest as ingest
    c = _cat(spark, sf_dir).orders.select(F.col("o_orderkey").alias("seq"), F.col("o_custkey").cast("string").alias("taxpayer_id"))
    dst = _scratch(spark, f"{name}-dst")
    for half in (0, 1):
        src, ck = _scratch(spark, f"{name}-src"), _scratch(spark, f"{name}-ckpt")
        c.where(F.col("seq") % 2 == half).write.json(f"{src}/drop=1")
        ingest(spark, src, dst, ck, c.schema, key_fn=lambda d: F.col("taxpayer_id"))
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{ck}/commits")
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, True)
    ingest(spark, src, dst, ck, c.schema, key_fn=lambda d: F.col("taxpayer_id"))
    return dst


@query
def stream_two_runs(spark, sf_dir):
    """K1 / K4 / K5: a second run with a new checkpoint keeps the first one's rows and skips its
    keys; a replay of its batch changes nothing."""
    from recordlink.streaming.incremental import read_ingested
    return read_ingested(spark, _two_runs(spark, sf_dir, "two-runs")).select("seq", "taxpayer_id")


@query
def stream_run_report(spark, sf_dir):
    """K6: rows completed, written and skipped over all runs, counted by the writing plans themselves."""
    from recordlink.streaming.incremental import ingest_report
    n = _cat(spark, sf_dir).orders.count()
    return (ingest_report(spark, _two_runs(spark, sf_dir, "report"), expected_rows=2 * n).where("run_id is null")
            .select("batches", "completed", "written", "skipped", "without_key", "pending", F.round("percent", 6).alias("percent")))


@query
def stream_ingest(spark, sf_dir):
    """K1/K2/K4: two file drops ingested by a resumable stream; keys already
    written are skipped, first row per key inside a drop."""
    from recordlink.operators.schema import resolve_key
    from recordlink.streaming.incremental import read_ingested, stream_ingest as ingest
    cat = _cat(spark, sf_dir)
    existing, batch = _split_registry(cat)
    src, dst, ck = _scratch(spark, "stream-src"), _scratch(spark, "stream-dst"), \
        _scratch(spark, "stream-ckpt")
    schema = existing.schema
    existing.write.json(f"{src}/drop=1")
    ingest(spark, src, dst, ck, schema, key_fn=resolve_key)
    batch.write.json(f"{src}/drop=2")
    ingest(spark, src, dst, ck, schema, key_fn=resolve_key)
    return read_ingested(spark, dst).select("seq", "taxpayer_number", "taxpayer_id")


@query
def lookup_batch(spark, sf_dir):
    """L2 with E11: cached keys from the account table, others fetched once."""

    # Stand-in for a remote account lookup: a pure function of the key. Defined
    # here so that it is shipped to the Python workers with the task.
    def _fetch_status(key):
        if key.endswith("7"):
            raise ValueError("lookup failed")
        if key.endswith("3"):
            return None
        return {"status": "ACTIVE" if int(key[-1]) % 2 == 0 else "INACTIVE"}

    from pyspark.sql import types as T
    from recordlink.operators.aggregate import distinct_keys
    from recordlink.operators.schema import resolve_key
    from recordlink.streaming.lookup import lookup_batch as lb
    cat = _cat(spark, sf_dir)
    reg = fx_registry(cat)
    keys = distinct_keys(reg, resolve_key(reg))
    schema = T.StructType([T.StructField("status", T.StringType())])
    return lb(keys, "taxpayer_id", _fetch_status, schema, max_parallel=8,
              cache=fx_account(cat).select("taxpayer_id", "status"))


# ---------------------------------------------------------------------------
# More inventory items: place matching, id split, smart merge, semantic
# lookup, empty values, safe casts, dates, previews, summaries, landed bodies,
# multi-dataset read, Arrow batches.
# ---------------------------------------------------------------------------

def _unique_registry(cat):
    from recordlink.operators import dedup as D
    return D.unique(D.dedup(fx_registry(cat)))


@query
def places_match(spark, sf_dir):
    """Search text per record joined to landed search responses; those of one
    city were landed under another search text, and blank-named outlets have no hit."""
    from recordlink.operators.places import match_places, search_query as sq
    cat = _cat(spark, sf_dir)
    recs = _unique_registry(cat)
    resp = recs.select(
        F.col("seq"), F.when(F.col("taxpayer_city") == "GERMANY", F.concat(sq(recs), F.lit(" (old)"))).otherwise(sq(recs))
        .alias("search_query"),
        F.when(F.col("outlet_name") == "", F.array().cast("array<struct<id:string>>"))
        .otherwise(F.array(F.struct(F.concat(F.lit("P"), F.col("seq").cast("string")).alias("id"))))
        .alias("places"))
    return match_places(recs, resp).select("taxpayer_id", "search_query", "place_id", "match_status")


@query
def id_validation(spark, sf_dir):
    """Keys split into valid (cleaned) and invalid."""
    from recordlink.functions.expr import clean_key, valid_key
    c = fx_contacts(_cat(spark, sf_dir))
    return c.select("seq", "taxpayer_id", valid_key("taxpayer_id").alias("is_valid"),
                    clean_key("taxpayer_id").alias("cleaned_id"))


@query
def smart_merge(spark, sf_dir):
    """C11: normalised overlay of two joined records, right side wins."""
    from recordlink.operators.schema import smart_merge as sm
    cat = _cat(spark, sf_dir)
    m = sm(fx_account(cat), fx_places(cat), on="taxpayer_id", priority="right", order_by="seq")
    return m.select("taxpayer_id", "seq", "business_name", "status", "place_id", "street_address",
                    F.array_join("_source_left_fields", ",").alias("left_fields"),
                    F.array_join("_source_right_fields", ",").alias("right_fields"))


@query
def semantic_fields(spark, sf_dir):
    """Values by canonical name, whatever the column is called."""
    from recordlink.operators.schema import semantic_col
    reg = fx_registry(_cat(spark, sf_dir))
    return reg.select("seq", semantic_col(reg, "business_name").alias("business_name"),
                      semantic_col(reg, "taxpayer_id").alias("taxpayer_id"),
                      semantic_col(reg, "city").cast("string").alias("city"))


@query
def remove_empty(spark, sf_dir):
    """Empty strings become NULL."""
    from recordlink.operators.schema import remove_empty_values
    return remove_empty_values(fx_contacts(_cat(spark, sf_dir)))


@query
def safe_casts(spark, sf_dir):
    """Casts with defaults and clamping."""
    from recordlink.functions.expr import clamp, safe_float, safe_int
    c = fx_contacts(_cat(spark, sf_dir))
    return c.select("seq", safe_int("zip").alias("zip_int"), safe_float("zip", -1.0).alias("zip_float"),
                    clamp(F.col("seq"), 100, 1000).alias("seq_clamped"))


@query
def date_checks(spark, sf_dir):
    """Strptime-style validation and formatting."""
    from recordlink.functions.dates import format_datetime, valid_date
    reg = fx_registry(_cat(spark, sf_dir))
    return reg.select("seq", valid_date("outlet_permit_issue_date").alias("valid_date"),
                      valid_date("outlet_permit_issue_date", "%d/%m/%Y").alias("valid_dmy"),
                      format_datetime(F.to_date("outlet_permit_issue_date"), "%d/%m/%Y").alias("dmy"))


@query
def preview_rows(spark, sf_dir):
    """H4: first five rows by input order, first eight fields."""
    from recordlink.operators.search import first_n
    return first_n(fx_registry(_cat(spark, sf_dir)), 5, "seq", columns=8)


@query
def dedup_nullkeys_one(spark, sf_dir):
    """G8 (accelerated path): rows without key count as one key; one survives."""
    from recordlink.operators import dedup as D
    f = D.dedup(fx_registry(_cat(spark, sf_dir)), "key", null_keys="group")
    return D.unique(f).select("seq", "taxpayer_number")


@query
def processing_summary(spark, sf_dir):
    """lookup run summary over the account lookups."""
    from recordlink.operators.aggregate import distinct_keys, processing_summary as ps
    from recordlink.functions.expr import clean_key
    from recordlink.operators.schema import resolve_key
    cat = _cat(spark, sf_dir)
    reg = fx_registry(cat)
    # lookups of customers in arrears were answered with an error
    failed = cat.customer.select(F.concat(F.lit("3-"), (F.lit(2000000000) + F.col("c_custkey")).cast("string")).alias("k"),
                                 F.when(F.col("c_acctbal") < 0, F.lit("HTTP 503")).alias("error"))
    failed = failed.select(clean_key("k").alias("taxpayer_id"), "error")
    s = ps(_account_info(cat, distinct_keys(reg, resolve_key(reg)), errors=failed))
    return s.select("total_records", "with_details", "with_ftas", "errors",
                    F.round("with_details_pct", 6).alias("with_details_pct"),
                    F.round("with_ftas_pct", 6).alias("with_ftas_pct"),
                    F.round("errors_pct", 6).alias("errors_pct"))


@query
def merge_row_counts(spark, sf_dir):
    """Rows in and out of a combine."""
    from recordlink.operators.aggregate import row_counts
    cat = _cat(spark, sf_dir)
    reg, acc = fx_registry(cat), fx_account(cat)
    return row_counts(registry=reg, account=acc, combined=C.combine(reg, acc))


@query
def landed_status(spark, sf_dir):
    """A10: landed status bodies (single objects) read as lists of records."""
    from recordlink.sources.landed import parse_status_body
    st = fx_status(_cat(spark, sf_dir))
    bodies = st.select("taxpayer_id", F.col("seq").alias("body_seq"),
                       F.to_json(F.struct("right_to_transact", "report_year")).alias("body"))
    p = parse_status_body(bodies.select("taxpayer_id", "body", "body_seq"), "body",
                          "struct<right_to_transact:string,report_year:string>")
    return p.select("taxpayer_id", F.col("pos").cast("int").alias("pos"), "right_to_transact",
                    "report_year")


@query
def arrow_batches(spark, sf_dir):
    """L1: a pandas function over Arrow batches of the customer table."""
    from recordlink.streaming.lookup import map_batches

    def fn(pdf):
        return pdf.assign(name_len=pdf["c_name"].str.len().astype("int64"))[["c_custkey", "name_len"]]

    c = _cat(spark, sf_dir).customer.select("c_custkey", "c_name")
    return map_batches(c, fn, "c_custkey long, name_len long")


@query
def search_names(spark, sf_dir):
    """First ten registry rows per requested city name (names of one region)."""
    from recordlink.operators.search import search_names as sn
    cat = _cat(spark, sf_dir)
    names = cat.nation.join(cat.region.where(F.col("r_name") == "EUROPE"),
                            F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.lower("n_name").alias("name"))
    r = sn(fx_registry(cat), names, "taxpayer_city", per=10)
    return r.select("query_name", "seq", "taxpayer_city")


@query
def search_names_contains(spark, sf_dir):
    """Every order whose clerk and comment-like text contains a requested name; short names and
    LIKE characters included."""
    from recordlink.operators.search import search_names_contains as sn
    cat = _cat(spark, sf_dir)
    texts = cat.customer.select(F.col("c_custkey").alias("seq"),
                                F.concat_ws(" ", "c_name", "c_mktsegment", F.concat("c_mktsegment", F.lit("_100%"))).alias("text"))
    names = (cat.nation.select(F.lower(F.substring("n_name", 1, 4)).alias("name"))
             .unionByName(cat.customer.select(F.substring("c_mktsegment", 2, 5).alias("name")))
             .unionByName(cat.customer.select(F.concat(F.lit("#"), F.right("c_name", F.lit(4))).alias("name")))
             .unionByName(cat.region.select(F.lower(F.substring("r_name", 2, 2)).alias("name")))
             .unionByName(cat.region.select(F.concat(F.lit("_"), F.lit("1")).alias("name")))
             .unionByName(cat.customer.select(F.right("c_name", F.lit(5)).alias("name"))))
    return sn(texts, names, "text", per=10).select("query_name", "seq")


@query
def merge_outer_split(spark, sf_dir):
    """Keys repeated on both sides, NULL keys, and keys of more rows than one task may take."""
    cat = _cat(spark, sf_dir)
    left = cat.orders.select(F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey") % 400).alias("k"), "o_orderkey",
                             F.col("o_totalprice").alias("amount"))
    right = cat.customer.select(F.when(F.col("c_custkey") % 11 != 0, F.col("c_custkey") % 431).alias("k"), "c_custkey",
                                F.col("c_acctbal").alias("amount"))
    return C.merge_outer(left, right, "k", hot_rows=10)


@query
def group_medians(spark, sf_dir):
    """exact medians of even and odd groups, one of which has a third of the rows."""
    from recordlink.operators.aggregate import group_medians as gm
    li = _cat(spark, sf_dir).lineitem
    g = F.when(F.col("l_orderkey") % 3 == 0, F.lit("third")).otherwise(F.concat(F.lit("s"), (F.col("l_suppkey") % 97).cast("string")))
    return gm(li.select(g.alias("grp"), "l_extendedprice"), "grp", "l_extendedprice", "median_price").select(
        "grp", F.round("median_price", 6).alias("median_price"))


@query
def lookup_windowed(spark, sf_dir):
    """L2: every customer looked up with eight calls in flight per task; results come as they end."""
    def _fetch(key):
        import time
        time.sleep((int(key) % 5) / 5000)
        if key.endswith("7"):
            raise ValueError("lookup failed")
        return None if key.endswith("3") else {"status": "ACTIVE" if int(key) % 2 == 0 else "INACTIVE"}

    from pyspark.sql import types as T
    from recordlink.streaming.lookup import lookup_batch as lb
    keys = _cat(spark, sf_dir).customer.select(F.col("c_custkey").cast("string").alias("taxpayer_id"))
    schema = T.StructType([T.StructField("status", T.StringType())])
    return lb(keys, "taxpayer_id", _fetch, schema, max_parallel=8, window=8, timeout_s=60).drop("from_cache")


@query
def lookup_resumed(spark, sf_dir):
    """K3: the keys of all orders land in two drops; the run is stopped after the first, its last
    batch replayed, and failed keys are asked once more."""
    def _first(key):
        if key.endswith("7"):
            raise ValueError("lookup failed")
        return {"status": f"S{int(key) % 4}"}

    def _second(key):
        if key.endswith("77"):
            raise ValueError("lookup failed again")
        return {"status": "RETRIED"}

    from pyspark.sql import types as T
    from recordlink.streaming.lookup import lookup_run, retry_failed
    keys = _cat(spark, sf_dir).orders.select(F.col("o_custkey").cast("string").alias("taxpayer_id"), "o_orderkey")
    src, dst, ck = (_scratch(spark, f"lookups-{x}") for x in ("src", "dst", "ckpt"))
    schema = T.StructType([T.StructField("status", T.StringType())])
    for half in (0, 1):
        keys.where(F.col("o_orderkey") % 2 == half).select("taxpayer_id").write.parquet(f"{src}/drop={half}")
        lookup_run(spark, src, dst, ck, "taxpayer_id", _first, schema, max_parallel=8, window=4)
    commits = spark._jvm.org.apache.hadoop.fs.Path(f"{ck}/commits")
    commits.getFileSystem(spark._jsc.hadoopConfiguration()).delete(commits, True)
    lookup_run(spark, src, dst, ck, "taxpayer_id", _first, schema, max_parallel=8, window=4)
    out = retry_failed(spark, dst, "taxpayer_id", _second, schema, max_parallel=8, window=4)
    return out.select("taxpayer_id", "status", "error", F.col("attempt").cast("int").alias("attempt"))


@query
def file_digests(spark, sf_dir):
    """The files of the written orders, read in blocks, have the digests of their whole contents,
    and a manifest checked in blocks verifies."""
    from recordlink.sources.sinks import file_checksums, verify_manifest, write_manifest
    path = _scratch(spark, "digests")
    _cat(spark, sf_dir).orders.write.parquet(path)
    whole, blocks = (file_checksums(spark, path, glob="*.parquet", whole_up_to=n).select("path", "checksum") for n in (1 << 30, 0))
    write_manifest(spark, path, glob="*.parquet")
    checked = verify_manifest(spark, path, glob="*.parquet", whole_up_to=0, block_bytes=1 << 16)
    both = whole.join(blocks.withColumnRenamed("checksum", "by_blocks"), "path", "full_outer").join(checked, "path", "full_outer")
    return both.agg(F.bool_and(F.col("checksum").eqNullSafe(F.col("by_blocks"))).alias("all_equal"),
                    F.bool_and(F.col("status").eqNullSafe(F.lit("verified"))).alias("all_verified"))


@query
def dedup_all_files(spark, sf_dir):
    """M7: registry and contacts written as files of two formats, each de-duplicated on its own."""
    from recordlink.plans.pipelines import dedup_files
    from recordlink.sources.sinks import write_csv, write_json
    cat, base = _cat(spark, sf_dir), _scratch(spark, "dedup-files")
    write_json(fx_registry(cat).select("seq", "taxpayer_number", "taxpayer_name"), f"{base}/registry.json")
    write_csv(fx_account(cat).select("seq", "taxpayer_id", "status"), f"{base}/account.csv")
    return dedup_files(spark, {"registry": f"{base}/registry.json", "account": f"{base}/account.csv"}, f"{base}/out",
                       key_fields=["taxpayer_id", "taxpayer_number"])


@query
def account_job(spark, sf_dir):
    """The keys of two sources looked up once each, flattened and exported by source."""
    from pyspark.sql import types as T

    from recordlink.plans.pipelines import account_job as job

    def _detail(key):
        n = int(key) % 1000
        if n % 10 == 7:
            raise ValueError("lookup failed")
        return None if n % 10 == 3 else {"status": f"S{n % 4}"}

    def _status(key):
        n = int(key) % 1000
        return {"report_year": "2020"} if n % 3 == 1 else [{"report_year": str(2000 + i)} for i in range(n % 3)]

    out, cat = _scratch(spark, "account-job"), _cat(spark, sf_dir)
    job(spark, {"registry": fx_registry(cat), "account": fx_account(cat)}, out, _detail,
        T.StructType([T.StructField("status", T.StringType())]), _status,
        T.StructType([T.StructField("report_year", T.StringType())]), window=4)
    return spark.read.parquet(f"{out}/accounts").select("source", "taxpayer_id", "has_details", "has_ftas", "ftas_count",
                                                        "detail_status", "ftas_report_year", "error")
