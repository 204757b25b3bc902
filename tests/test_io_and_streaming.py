"""Sources, sinks, manifest and the resumable stream, in fresh scratch folders."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from recordlink.sources import readers as R
from recordlink.sources import sinks as S
from recordlink.streaming.incremental import read_ingested, stream_ingest
from recordlink.streaming.lookup import lookup_batch, map_batches


def _tmp():
    return tempfile.mkdtemp(prefix="rl-test-")


def test_json_array_wrapper_csv_bom(spark):
    d = _tmp()
    with open(os.path.join(d, "a.json"), "w") as f:
        json.dump([{"taxpayer_id": "12345678901", "name": "A"}, {"taxpayer_id": "", "name": "B"}], f)
    with open(os.path.join(d, "w.json"), "w") as f:
        json.dump({"data": [{"taxpayer_id": "99999999999", "name": "C"}]}, f)
    with open(os.path.join(d, "c.csv"), "w", encoding="utf-8-sig") as f:
        f.write("taxpayer_id,name\n00123456789,D\n,E\n")
    assert R.read_auto(spark, os.path.join(d, "a.json")).count() == 2
    assert R.read_auto(spark, os.path.join(d, "w.json")).first().name == "C"
    c = R.read_auto(spark, os.path.join(d, "c.csv"))
    assert c.columns == ["taxpayer_id", "name"]
    assert [r.taxpayer_id for r in c.collect()] == ["00123456789", None]   # text kept, no BOM


def test_read_dir_skips_corrupt_and_dedups(spark):
    d = _tmp()
    with open(os.path.join(d, "1.jsonl"), "w") as f:
        f.write('{"taxpayer_id": "12345678901", "v": 1}\n{"taxpayer_id": "", "v": 2}\n')
    with open(os.path.join(d, "2.jsonl"), "w") as f:
        f.write('{"taxpayer_id": "123-456-78901", "v": 3}\n{broken\n{"taxpayer_id": "", "v": 4}\n')
    with open(os.path.join(d, "2.jsonl.checksum"), "w") as f:
        f.write("not data")
    df = R.read_dir(spark, d, "jsonl", order_by="_in_seq")
    assert sorted(r.v for r in df.collect()) == [1, 2, 4]


def test_manifest_statuses(spark):
    d = _tmp()
    t = os.path.join(d, "t")
    os.makedirs(t)
    for name, body in [("a.bin", b"aaaa"), ("b.bin", b"bbbb"), ("c.bin", b"cccc")]:
        with open(os.path.join(t, name), "wb") as f:
            f.write(body)
    mp = S.write_manifest(spark, t, glob="*.bin")
    with open(os.path.join(t, "a.bin"), "ab") as f:      # size changes
        f.write(b"x")
    with open(os.path.join(t, "b.bin"), "wb") as f:      # same size, other bytes
        f.write(b"bbbB")
    with open(os.path.join(t, "d.bin"), "wb") as f:      # not in the manifest
        f.write(b"d")
    m = spark.read.parquet(mp)                            # listed but absent
    m.limit(1).withColumn("path", F.concat(F.col("path"), F.lit(".gone"))) \
        .write.mode("append").parquet(mp)
    st = {r.path.rsplit("/", 1)[-1]: r.status for r in S.verify_manifest(spark, t, glob="*.bin").collect()}
    assert st["a.bin"] == "size_mismatch" and st["b.bin"] == "checksum_mismatch"
    assert st["c.bin"] == "verified" and st["d.bin"] == "untracked"
    assert sorted(v for k, v in st.items() if k.endswith(".gone")) == ["missing"]


def test_stream_resume(spark):
    d = _tmp()
    src, dst, ck = os.path.join(d, "src"), os.path.join(d, "dst"), os.path.join(d, "ck")
    os.makedirs(src)
    schema = "seq long, taxpayer_id string"
    from recordlink.operators.schema import resolve_key
    spark.createDataFrame([(1, "12345678901"), (2, "12345678901"), (3, "")], schema).write.json(src + "/drop=1")
    r1 = stream_ingest(spark, src, dst, ck, spark.createDataFrame([], schema).schema, key_fn=resolve_key)
    assert read_ingested(spark, dst).count() == 2
    spark.createDataFrame([(4, "123-456-78901"), (5, "99999999999")], schema).write.json(src + "/drop=2")
    r2 = stream_ingest(spark, src, dst, ck, spark.createDataFrame([], schema).schema, key_fn=resolve_key)
    assert sorted(r.seq for r in read_ingested(spark, dst).collect()) == [1, 3, 5]
    assert sum(x["input_rows"] or 0 for x in r2) == 2   # only the new drop was read
    assert r1


def test_lookup_errors_and_cache(spark):
    from pyspark.sql import types as T
    keys = spark.createDataFrame([("1",), ("2",), ("3",), ("2",)], "k string")
    cache = spark.createDataFrame([("1", "cached")], "k string, v string")

    def fetch(k):
        if k == "3":
            raise RuntimeError("boom")
        return {"v": "fetched-" + k}

    out = {r.k: r for r in lookup_batch(keys, "k", fetch, T.StructType([T.StructField("v", T.StringType())]),
                                         max_parallel=2, cache=cache).collect()}
    assert out["1"].v == "cached" and out["1"].from_cache
    assert out["2"].v == "fetched-2" and out["2"].error is None
    assert out["3"].v is None and out["3"].error.startswith("RuntimeError")
    m = map_batches(spark.range(10), lambda pdf: pdf.assign(id=pdf["id"] * 2), "id long")
    assert sorted(r.id for r in m.collect()) == list(range(0, 20, 2))


def test_stream_watermark_dedup(spark):
    d = _tmp()
    src, dst, ck = os.path.join(d, "src"), os.path.join(d, "dst"), os.path.join(d, "ck")
    schema = "seq long, taxpayer_id string, ts timestamp"
    from recordlink.operators.schema import resolve_key
    rows = [(1, "12345678901", "2024-01-01 00:00:00"), (2, "12345678901", "2024-01-01 01:00:00"),
            (3, "99999999999", "2024-01-01 02:00:00")]
    spark.createDataFrame(rows, "seq long, taxpayer_id string, ts string") \
        .withColumn("ts", F.to_timestamp("ts")).write.json(src + "/drop=1")
    st = spark.createDataFrame([], schema).schema
    stream_ingest(spark, src, dst, ck, st, key_fn=resolve_key, event_time_col="ts", late_after="1 day")
    got = sorted(r.taxpayer_id for r in read_ingested(spark, dst).collect())
    assert got == ["12345678901", "99999999999"]


def test_stream_watermark_keeps_keyless_rows(spark):
    d = _tmp()
    src, dst, ck = os.path.join(d, "src"), os.path.join(d, "dst"), os.path.join(d, "ck")
    from recordlink.operators.schema import resolve_key
    spark.createDataFrame([(1, "", "2024-01-01 00:00:00"), (2, "", "2024-01-01 00:10:00"),
                           (3, "12345678901", "2024-01-01 00:20:00")], "seq long, taxpayer_id string, ts string") \
        .withColumn("ts", F.to_timestamp("ts")).write.json(src + "/drop=1")
    st = spark.createDataFrame([], "seq long, taxpayer_id string, ts timestamp").schema
    stream_ingest(spark, src, dst, ck, st, key_fn=resolve_key, event_time_col="ts")
    assert sorted(r.seq for r in read_ingested(spark, dst).collect()) == [1, 2, 3]


def test_json_layouts_read_in_full(spark, tmp_path):
    from recordlink.sources import sinks as S2
    df = spark.range(0, 1000).selectExpr("cast(id as string) as taxpayer_id", "id * 2 as v").repartition(2)
    S2.write_json(df, str(tmp_path / "lines.json"))
    assert R.read_auto(spark, str(tmp_path / "lines.json"), fmt="json").count() == 1000
    got, _ = S2.verify_and_load(spark, str(tmp_path / "lines.json"), fmt="json")
    assert got.count() == 1000
    d = tmp_path / "mixed"
    d.mkdir()
    (d / "array.json").write_text('[{"taxpayer_id": "1"}, {"taxpayer_id": "2"}]')
    (d / "indented.json").write_text('[\n  {\n    "taxpayer_id": "3"\n  },\n  {\n    "taxpayer_id": "4"\n  }\n]\n')
    (d / "lines.jsonl").write_text('{"taxpayer_id": "5"}\n\n{"taxpayer_id": "6"}\n')
    (d / "object.json").write_text('{\n "taxpayer_id": "7"\n}')
    (d / "empty.json").write_text("")
    (d / "array.json.checksum").write_text('{"taxpayer_id": "99"}')
    for fmt in ("json", "jsonl"):
        got = R.read_dir(spark, str(d), fmt, order_by="_in_seq")
        assert sorted(r.taxpayer_id for r in got.collect()) == list("1234567")


def test_csv_cells_with_quotes_and_newlines(spark, tmp_path):
    from recordlink.sources import sinks as S2
    rows = [("1", 'He said "hi", ok'), ("2", "two\nlines"), ("3", "plain"), ("4", 'a\\b"c\\')]
    S2.write_csv(spark.createDataFrame(rows, "k string, t string"), str(tmp_path / "c"))
    got = R.read_auto(spark, str(tmp_path / "c"), fmt="csv")
    assert sorted((r.k, r.t) for r in got.collect()) == rows


def test_read_dir_malformed_records_are_returned(spark, tmp_path):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    (tmp_path / "a.jsonl").write_text('{"taxpayer_id": "1", "n": 1}\n{"taxpayer_id": "2", "n": "bad"}\n{"taxpayer_id": "3", "n": 3}\n'
                                      '{"taxpayer_id": "4", "n": 4}\n{"taxpayer_id": "4", "n": 5}\n{broken\n')
    schema = T.StructType([T.StructField("taxpayer_id", T.StringType()), T.StructField("n", T.LongType())])
    got = R.read_dir(spark, str(tmp_path), "jsonl", schema=schema, key=F.col("taxpayer_id"))
    assert sorted((r.taxpayer_id, r.n) for r in got.collect()) == [("1", 1), ("3", 3), ("4", 4)]
    rows, bad = R.read_dir_checked(spark, str(tmp_path), "jsonl", schema)
    assert rows.count() == 4 and sorted(r._corrupt_record for r in bad.collect()) == ['{"taxpayer_id": "2", "n": "bad"}', "{broken"]


def test_json_layouts_and_cut_first_line(spark, tmp_path):
    good = [f'{{"id": {i}, "v": {{"w": [{i}]}}}}' for i in range(100)]
    texts = {"cut.json": "\n".join(['{"id": 100, "v": {"w"', *good]),
             "lines.json": "\n".join([*good, '{"id": 7']),
             "nan.json": '{"id": NaN}\n{"id": NaN}\n',
             "array.json": "[\n" + ",\n".join(good) + "\n]",
             "leading.json": "[\n" + "\n,".join(good) + "]",
             "tight.json": '[\n{"id": 1}]',
             "object.json": '{"a": {"id": 1},\n"b":\n{"id": 2}\n}',
             "blank.json": "\n\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    lines, whole = ({f.rsplit("/", 1)[1] for f in x} for x in R._json_files(spark, str(tmp_path)))
    assert lines == {"cut.json", "lines.json", "nan.json"}
    assert whole == {"array.json", "leading.json", "tight.json", "object.json"}
    cut = tmp_path / "only"
    cut.mkdir()
    (cut / "cut.json").write_text(texts["cut.json"])
    rows, bad = R.read_dir_checked(spark, str(cut), "json")
    assert (rows.count(), bad.count()) == (100, 1)


def test_stream_batch_replay_writes_the_same_rows(spark, tmp_path):
    import shutil
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    from recordlink.streaming.incremental import read_ingested, stream_ingest
    src, dst, ck = (str(tmp_path / x) for x in ("src", "dst", "ck"))
    schema = T.StructType([T.StructField("taxpayer_id", T.StringType()), T.StructField("seq", T.LongType())])

    def land(name, ids):
        (tmp_path / "src").mkdir(exist_ok=True)
        (tmp_path / "src" / name).write_text("".join(f'{{"taxpayer_id": "{i}", "seq": {n}}}\n' for n, i in enumerate(ids)))

    def run():
        stream_ingest(spark, src, dst, ck, schema, key_fn=lambda d: F.col("taxpayer_id"))
        return sorted(r.taxpayer_id for r in read_ingested(spark, dst).collect())

    land("a.json", "12334")
    assert run() == list("1234")
    land("b.json", "4556")
    assert run() == list("123456")
    shutil.rmtree(f"{ck}/commits")          # as if the last batch had not been committed
    assert run() == list("123456")
    assert run() == list("123456")


def test_stream_runs_share_their_history(spark, tmp_path):
    """A run with a new checkpoint keeps earlier rows, skips their keys and opens few buckets."""
    from pyspark.sql import functions as F
    from recordlink.streaming import incremental as I
    dst, schema = str(tmp_path / "dst"), "seq long, taxpayer_id string, note string"

    def drop(name, lo, hi, ck, key=True, **kw):
        (spark.range(lo, hi).select(F.col("id").alias("seq"), F.when(F.col("id") % 10 != 9, (F.col("id") % 50).cast("string")).alias("taxpayer_id"),
                                    F.lit(name).alias("note")).write.json(str(tmp_path / name / "drop=1")))
        from pyspark.sql.types import _parse_datatype_string
        return I.stream_ingest(spark, str(tmp_path / name), dst, str(tmp_path / ck), _parse_datatype_string(schema),
                               key_fn=(lambda d: F.col("taxpayer_id")) if key else None, **kw)

    drop("a", 0, 20, "ck1")
    drop("b", 15, 40, "ck2", buckets=16)            # another run, another number of buckets
    rows = {(r.seq, r.note) for r in I.read_ingested(spark, dst).collect()}
    assert rows == {(i, "a") for i in range(20)} | {(i, "b") for i in range(15, 40) if i % 10 == 9 or i >= 20}
    known = spark.createDataFrame([("3",), ("21",), (None,), ("777",)], "taxpayer_id string")
    seen = I.earlier_keys(known, dst, "taxpayer_id", "none", 0)
    assert {"3", "21"} <= {r[0] for r in seen.collect()}
    assert seen.count() < spark.read.parquet(I.keys_path(dst)).count() / 2
    assert "PartitionFilters" in (plan := seen._jdf.queryExecution().executedPlan().toString()) and "bucket" in plan.split("PartitionFilters")[1][:300]
    assert I.earlier_keys(known.where("taxpayer_id = '777'"), dst, "taxpayer_id", "none", 0) is None
    total = I.ingest_report(spark, dst, expected_rows=90).where("run_id is null").first()
    assert (total.batches, total.completed, total.written, total.skipped, total.without_key, total.pending, total.percent) == \
        (2, 45, len(I.read_ingested(spark, dst).collect()), 45 - len(rows), 5, 45, 50.0)
    drop("c", 0, 5, "ck3", key=False)               # plain append
    assert I.read_ingested(spark, dst).count() == len(rows) + 5
