"""Whole jobs over several files, lookups and pages; digests of files in blocks."""

import hashlib
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.plans import pipelines as PL
from recordlink.sources import sinks as S
from recordlink.sources.landed import status_list


def _tmp():
    return tempfile.mkdtemp(prefix="rl-jobs-")


def test_digests_in_blocks(spark):
    d = _tmp()
    open(os.path.join(d, "empty.bin"), "w").close()         # Spark lists no empty files
    bodies = {"a b.bin": os.urandom(3_000_001), "exact.bin": b"x" * (1 << 20), "small.bin": b"abc"}
    for name, body in bodies.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(body)
    for algorithm in ("sha256", "md5"):
        # above 1,000 bytes in blocks, the others whole
        got = {os.path.basename(r.path): (r.checksum, r.length) for r in
               S.file_checksums(spark, d, algorithm, whole_up_to=1000).collect()}
        assert got == {n: (hashlib.new(algorithm, b).hexdigest(), len(b)) for n, b in bodies.items()}
    S.write_manifest(spark, d, d + "_m")
    with open(os.path.join(d, "a b.bin"), "r+b") as f:
        f.seek(2_500_000)
        f.write(b"changed")
    status = {os.path.basename(r.path): r.status for r in S.verify_manifest(spark, d, d + "_m", whole_up_to=1000).collect()}
    assert status == {n: "checksum_mismatch" if n == "a b.bin" else "verified" for n in bodies}


def test_large_files_are_not_opened_whole(spark):
    d = _tmp()
    with open(os.path.join(d, "f.bin"), "wb") as f:
        f.write(b"x")
    plan = S.file_checksums(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert f"LessThanOrEqual(length,{S.WHOLE_UP_TO})" in plan


def test_status_list(spark):
    df = spark.createDataFrame([("32000000001", "Acme ", "0007", "A"), ("32000000002", "ACME", "8", "B"), (None, None, None, "C")],
                               "taxpayer_id string, name string, file_number string, state string")

    def states(**by):
        return sorted(r.state for r in status_list(df, **by).collect())

    assert states(taxpayer_id="3-2000000001") == ["A"]
    assert states(name="acme") == ["A", "B"]
    assert states(file_number=" 8 ") == ["B"]
    assert states(name="Acme", file_number="0007") == ["A"]
    assert states(name="nobody") == []
    with pytest.raises(ValueError):
        status_list(df)


@pytest.mark.parametrize("mode,unique", [("key", 3), ("exact", 4), ("hash", 4), ("merge", 3), ("best", 3)])
def test_dedup_files(spark, mode, unique):
    d = _tmp()
    rows = [{"taxpayer_id": "1", "name": "a", "city": None}, {"taxpayer_id": "1", "name": "a", "city": "x"},
            {"taxpayer_id": "2", "name": "b", "city": "y"}, {"taxpayer_id": "2", "name": "b", "city": "y"},
            {"taxpayer_id": None, "name": "c", "city": "z"}]
    with open(os.path.join(d, "one.json"), "w") as f:
        f.write("\n".join(map(json.dumps, rows)))
    with open(os.path.join(d, "two.csv"), "w") as f:
        f.write("taxpayer_id,other\n1,q\n")
    stats = {r.file: (r.original_count, r.unique_count, r.duplicate_count) for r in PL.dedup_files(
        spark, {"one": os.path.join(d, "one.json"), "two": os.path.join(d, "two.csv")}, os.path.join(d, "out"), mode).collect()}
    assert stats == {"one": (5, unique, 5 - unique), "two": (1, 1, 0)}      # no row of one file meets another's
    kept = spark.read.parquet(os.path.join(d, "out", "unique")).where("file = 'one' and taxpayer_id = '1'")
    if mode in ("merge", "best"):
        assert [r.city for r in kept.collect()] == ["x"]
    else:
        removed = spark.read.parquet(os.path.join(d, "out", "removed"))
        assert removed.count() == 5 - unique


def test_dedup_files_refuses_other_modes(spark):
    with pytest.raises(ValueError):
        PL.dedup_files(spark, {}, "x", "other")


DETAIL = T.StructType([T.StructField("status", T.StringType()), T.StructField("balance", T.DoubleType())])


def _calls(folder):
    def fetch(key):
        with open(os.path.join(folder, key), "a") as f:
            f.write("x")
        if key.endswith("9"):
            raise ValueError("down")
        return None if key.endswith("8") else {"status": "ACTIVE", "balance": float(key[-1])}

    return fetch


def test_account_job_asks_once_and_uses_the_cache(spark):
    d, calls = _tmp(), _tmp()
    one = spark.createDataFrame([(f"3200000000{i}",) for i in (1, 2, 8, 9, 1)], "taxpayer_id string")
    two = spark.createDataFrame([("32000000001",), ("bad",), (None,)], "taxpayer_number string")
    cache = os.path.join(d, "cache")
    status = T.StructType([T.StructField("year", T.StringType())])
    for run in (1, 2):
        s = PL.account_job(spark, {"one": one, "two": two}, os.path.join(d, "out"), _calls(calls), DETAIL,
                           lambda k: [{"year": "2020"}, {"year": "2021"}] if k.endswith("1") else None, status, cache_path=cache).first()
        assert (s.total_records, s.with_details, s.with_ftas, s.errors) == (4, 2, 1, 1)
        rows = {(r.source, r.taxpayer_id): r for r in spark.read.parquet(os.path.join(d, "out", "accounts")).collect()}
        assert len(rows) == 5 and rows["two", "32000000001"].detail_status == "ACTIVE"
        assert rows["one", "32000000001"].ftas_count == 2 and rows["one", "32000000001"].ftas_year == "2020"
        assert rows["one", "32000000009"].error == "ValueError: down" and not rows["one", "32000000008"].has_details
        # found keys are asked once over both runs; a missing or failed one once a run
        asked = {k: os.path.getsize(os.path.join(calls, k)) for k in os.listdir(calls)}
        assert asked == {"32000000001": 1, "32000000002": 1, "32000000008": run, "32000000009": run}


def test_account_job_without_rows_or_status(spark):
    none = spark.createDataFrame([], "taxpayer_id string")
    s = PL.account_job(spark, {"one": none}, os.path.join(_tmp(), "out"), _calls(_tmp()), DETAIL).first()
    assert (s.total_records, s.with_details, s.errors) == (0, 0, 0)


def test_batch_pipeline(spark):
    d, calls = _tmp(), _tmp()
    os.mkdir(os.path.join(d, "pages"))
    for page, ids in enumerate((["32000000001", "32000000002"], ["32000000001", "32000000009"]), 1):
        with open(os.path.join(d, "pages", f"page_{page}.json"), "w") as f:
            json.dump([{"taxpayer_number": i, "taxpayer_name": f"N{page}"} for i in ids], f)
    stats = PL.batch_pipeline(spark, os.path.join(d, "pages"), os.path.join(d, "out"), _calls(calls), DETAIL)
    assert stats["total_records"] == 3 and stats["with_both_sources"] == 2
    out = {r.taxpayer_id: r for r in spark.read.parquet(os.path.join(d, "out", "combined", "parquet")).collect()}
    assert set(out) == {"32000000001", "32000000002", "32000000009"}
    assert out["32000000001"].account_balance == 1.0 and not out["32000000009"].has_account_data
    assert spark.read.parquet(os.path.join(d, "out", "registry", "parquet")).count() == 4
    assert spark.read.parquet(os.path.join(d, "out", "account", "parquet")).count() == 2


def test_datasets_report(spark):
    from recordlink.sources.readers import datasets_report, read_datasets
    d = _tmp()
    spark.range(7).select(F.col("id").cast("string").alias("taxpayer_id")).write.parquet(os.path.join(d, "a.parquet"))
    spark.range(0).select(F.col("id").cast("string").alias("taxpayer_id")).write.parquet(os.path.join(d, "b.parquet"))
    paths = {n: os.path.join(d, f"{n}.parquet") for n in "abc"}
    rows = datasets_report(spark, paths, read_datasets(spark, paths, limit_per_dataset=5)).collect()
    assert {r.dataset_id: (r.status, r["rows"]) for r in rows} == {"a": ("loaded", 5), "b": ("empty", 0), "c": ("missing", 0)}
