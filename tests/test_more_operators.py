"""Inventory items checked on small hand-made inputs (files in fresh folders)."""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.operators import combine as C
from recordlink.operators import schema as S
from recordlink.sources import readers as R
from recordlink.sources import sinks as S2
from recordlink.sources.landed import account_info
from recordlink.streaming.incremental import run_report


def _tmp():
    return tempfile.mkdtemp(prefix="rl-test-")


def test_latest_file_and_pages(spark):
    d = _tmp()
    for i, rows in enumerate([[{"a": 1}, {"a": 2}], [{"a": 3}]], start=1):
        with open(os.path.join(d, f"page_{i}.json"), "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows))
        time.sleep(0.05)
    os.utime(os.path.join(d, "page_1.json"), (time.time() + 100, time.time() + 100))
    assert R.latest_file(spark, d, "*.json").endswith("page_1.json")
    p = R.read_pages(spark, d, limit=2)
    assert [(r.page, r.a) for r in p.collect()] == [(1, 1), (1, 2)]
    assert R.files_newest_first(spark, d, "*.json").first().path.endswith("page_1.json")


def test_read_datasets_and_describe(spark):
    d = _tmp()
    spark.range(5).withColumnRenamed("id", "x").write.parquet(os.path.join(d, "a.parquet"))
    spark.range(3).withColumnRenamed("id", "y").write.parquet(os.path.join(d, "b.parquet"))
    u = R.read_datasets(spark, {"a": os.path.join(d, "a.parquet"), "b": os.path.join(d, "b.parquet"),
                                "missing": os.path.join(d, "nope.parquet")}, limit_per_dataset=2)
    got = sorted((r.dataset_id, r.x, r.y) for r in u.collect())
    assert [g[0] for g in got] == ["a", "a", "b", "b"]
    desc = R.describe_dataset(spark.read.parquet(os.path.join(d, "a.parquet"))).first()
    assert desc.rows == 5 and desc.columns == "x" and desc.last_modified is not None


def test_account_info_switches(spark):
    ids = spark.createDataFrame([("1",), ("2",)], "taxpayer_id string")
    det = spark.createDataFrame([("1", "A")], "taxpayer_id string, status string")
    st = spark.createDataFrame([(1, "1", "Y"), (2, "1", "N")], "seq int, taxpayer_id string, right string")
    a = {r.taxpayer_id: r for r in account_info(ids, det, st).collect()}
    assert (a["1"].has_details, a["1"].ftas_count, a["1"].ftas_right) == (True, 2, "Y")
    assert (a["2"].has_details, a["2"].has_ftas, a["2"].detail_status) == (False, False, None)
    only_d = account_info(ids, det, st, include_status=False).collect()
    assert all(r.ftas_count == 0 for r in only_d)
    assert account_info(ids, det, st, include_details=False, include_status=False).count() == 0


def test_write_all_and_append(spark):
    d = _tmp()
    df = spark.createDataFrame([(1, "a", [1, 2])], "id int, s string, arr array<int>")
    out = S2.write_all(df, os.path.join(d, "all"))
    assert set(out) == {"json", "csv", "parquet"}
    assert spark.read.option("header", True).csv(out["csv"]).first().arr == "[1,2]"
    p = os.path.join(d, "app")
    S2.write_append(spark.createDataFrame([(1, "x")], "id int, a string"), p)
    S2.write_append(spark.createDataFrame([(2, 5)], "id int, b int"), p)
    back = S2.read_appended(spark, p)
    assert sorted(back.columns) == ["a", "b", "id"] and back.count() == 2


def test_matching_fields_merge_structs_safe_get(spark):
    l = spark.createDataFrame([], "TaxpayerNumber string, zipcode string, other string")
    r = spark.createDataFrame([], "taxpayer_id string, postal_code string")
    assert S.matching_fields(l, r) == {"TaxpayerNumber": "taxpayer_id", "zipcode": "postal_code"}
    df = spark.createDataFrame([((1, (2, 3)), (9, (None, 7)))],
                               "a struct<x:int,n:struct<p:int,q:int>>, b struct<x:int,n:struct<p:int,r:int>>")
    t = df.schema
    deep = df.select(S.merge_structs(F.col("a"), t["a"].dataType, F.col("b"), t["b"].dataType, deep=True)
                     .alias("m")).first().m
    assert (deep.x, deep.n.p, deep.n.q, deep.n.r) == (9, None, 3, 7)
    assert df.select(S.safe_get(["a", "n", "q"], 0)).first()[0] == 3
    assert df.select(S.safe_get(["b", "n", "p"], -1)).first()[0] == -1


def test_match_keys_and_run_report(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "taxpayer_id string, name string")
    b = spark.createDataFrame([("1", "P1")], "taxpayer_id string, place_id string")
    assert [tuple(r) for r in C.match_keys(a, b).collect()] == [("1", "x", "P1")]
    rep = run_report(spark, [{"batch_id": 0, "input_rows": 3, "timestamp": "t"}])
    assert rep.first().input_rows == 3


def test_verify_and_load_and_folder_stats(spark):
    d = _tmp()
    p = os.path.join(d, "out")
    spark.range(10).write.parquet(p)
    df, st = S2.verify_and_load(spark, p, fmt="parquet", glob="*.parquet")
    assert df.count() == 10 and [r.status for r in st.collect()] == ["skipped"]
    S2.write_manifest(spark, p, glob="*.parquet")
    df, st = S2.verify_and_load(spark, p, fmt="parquet", glob="*.parquet")
    assert {r.status for r in st.collect()} == {"verified"}
    fs = S2.folder_stats(spark, p, "*.parquet").first()
    assert fs.files >= 1 and fs.bytes > 0


def test_append_to_cache(spark):
    from recordlink.streaming.lookup import append_to_cache, lookup_batch
    d = _tmp()
    cache_path = os.path.join(d, "cache")
    schema = T.StructType([T.StructField("v", T.StringType())])
    keys = spark.createDataFrame([("1",), ("2",), ("3",)], "k string")

    def fetch(k):
        if k == "3":
            raise ValueError("x")
        return {"v": "f" + k}

    r1 = lookup_batch(keys, "k", fetch, schema, max_parallel=2).persist()
    append_to_cache(r1, cache_path)
    cache = spark.read.parquet(cache_path)
    assert sorted(r.k for r in cache.collect()) == ["1", "2"]
    r2 = {r.k: r for r in lookup_batch(keys, "k", fetch, schema, max_parallel=2, cache=cache).collect()}
    assert r2["1"].from_cache and r2["2"].from_cache and not r2["3"].from_cache
