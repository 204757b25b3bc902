"""End-to-end jobs on the smallest driver tables, in fresh folders."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.plans import pipelines as PL
from recordlink.plans.catalog import Catalog
from recordlink.plans.fixtures import fx_account, fx_contacts, fx_places, fx_registry
from recordlink.operators import dedup as D
from tests.conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="rl-pipe-")


def test_master_combine_and_merge_source(spark):
    cat = Catalog(spark, SF_SMALL)
    d = _tmp()
    reg, acc = fx_registry(cat), fx_account(cat)
    reg.repartition(3).write.json(os.path.join(d, "reg"))
    acc.repartition(2).write.json(os.path.join(d, "acc"))
    stats = PL.master_combine(spark, os.path.join(d, "reg"), os.path.join(d, "acc"),
                              os.path.join(d, "out"), fmt="jsonl")
    assert stats["total_records"] == spark.read.parquet(os.path.join(d, "out")).count()
    assert stats["with_both_sources"] > 0
    PL.merge_source(spark, os.path.join(d, "reg"), os.path.join(d, "merged"), fmt="jsonl")
    merged = spark.read.parquet(os.path.join(d, "merged"))
    keyed = reg.where(F.col("taxpayer_number").rlike("[0-9]{9}"))
    assert merged.count() >= keyed.select("taxpayer_number").distinct().count()


def test_dedup_file_and_validate(spark):
    d = _tmp()
    fx_contacts(Catalog(spark, SF_SMALL)).drop("seq").coalesce(1).write.option("header", True) \
        .csv(os.path.join(d, "contacts.csv"))
    stats = PL.dedup_file(spark, os.path.join(d, "contacts.csv"), os.path.join(d, "u"),
                          review_out=os.path.join(d, "dups"))
    assert stats["original_count"] == stats["unique_count"] + stats["duplicate_count"]
    assert spark.read.parquet(os.path.join(d, "u", "parquet")).count() == stats["unique_count"]
    from recordlink.sources.readers import read_auto, with_seq
    flagged = D.dedup(with_seq(read_auto(spark, os.path.join(d, "contacts.csv")), "_in_seq"),
                      order_by="_in_seq")
    summary, first = PL.validate_after_dedup(flagged)
    assert summary.first().total_records == stats["unique_count"]
    assert first.count() <= 5


def test_clean_validate_outlets_places(spark):
    cat = Catalog(spark, SF_SMALL)
    d = _tmp()
    s = PL.clean_and_validate(fx_contacts(cat), os.path.join(d, "clean"), required=["business_name"])
    assert s["total_records"] == fx_contacts(cat).count()
    reg = fx_registry(cat)
    stats = PL.polish_outlets(reg, D.unique(D.dedup(reg)), os.path.join(d, "polish"))
    assert stats["total_source_records"] == reg.count() and stats["records_enriched"] > 0
    PL.final_combine(fx_account(cat), fx_places(cat), os.path.join(d, "final"))
    fin = spark.read.parquet(os.path.join(d, "final", "parquet"))
    assert fin.count() == fx_account(cat).count() and "google_places_enriched" in fin.columns
    rep, top = PL.quality_view(fx_contacts(cat), top=3)
    assert rep.count() == 1 and top.count() == 3


def test_places_two_step_and_lookup(spark):
    cat = Catalog(spark, SF_SMALL)
    from recordlink.operators.places import search_query
    recs = D.unique(D.dedup(fx_registry(cat)))
    search = recs.select("seq", search_query(recs).alias("search_query"),
                         F.array(F.struct(F.concat(F.lit("P"), F.col("seq").cast("string")).alias("id")))
                         .alias("places"))
    details = recs.select("seq", F.concat(F.lit("P"), F.col("seq").cast("string")).alias("place_id"),
                          F.struct(F.col("taxpayer_name").alias("text")).alias("displayName"))
    det, counts = PL.places_two_step(recs, search, details)
    assert {r.details_status for r in counts.collect()} == {"success"}
    assert det.where(F.col("name").isNull()).count() == 0
    schema = T.StructType([T.StructField("status", T.StringType())])
    out = PL.lookup_pipeline(fx_registry(cat), lambda k: {"status": "ok"}, schema)
    assert out.where(F.col("error").isNotNull()).count() == 0 and out.count() > 0


def test_load_datasets_and_registry_download(spark):
    cat = Catalog(spark, SF_SMALL)
    d = _tmp()
    paths = {n: f"{SF_SMALL}/{n}.parquet" for n in ("customer", "supplier")}
    PL.load_datasets(spark, paths, os.path.join(d, "multi"), limit_per_dataset=7)
    m = spark.read.parquet(os.path.join(d, "multi"))
    assert sorted(r.dataset_id for r in m.select("dataset_id").distinct().collect()) == ["customer", "supplier"]
    assert m.count() == 14
    pages = os.path.join(d, "pages")
    reg = fx_registry(cat)
    reg.where(F.col("seq") < 1000).coalesce(1).write.json(os.path.join(pages, "page_1"))
    import glob
    # pages are named page_<n>.json
    for i, f in enumerate(sorted(glob.glob(os.path.join(pages, "page_1", "*.json"))), start=1):
        os.link(f, os.path.join(pages, f"page_{i}.json"))
    hist = reg.where(F.col("seq") >= 1000)
    PL.registry_download(spark, os.path.join(pages, "page_*.json"), hist, os.path.join(d, "new"))
    assert spark.read.parquet(os.path.join(d, "new")).count() > 0
