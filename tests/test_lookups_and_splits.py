"""Bounded lookups, resumable lookup runs, and operators that split a hot key or group."""
import math
import os
import random
import statistics
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlink.operators.aggregate import group_agg, group_medians
from recordlink.operators.combine import _grid, merge_outer
from recordlink.operators.search import search_names_contains
from recordlink.streaming.lookup import calls_in_flight, lookup_batch, lookup_run, read_lookups, retry_failed

STATUS = T.StructType([T.StructField("status", T.StringType())])


def test_window_keeps_n_calls_in_flight():
    import threading
    now, most, lock = [0], [0], threading.Lock()

    def fetch(key):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02)
        with lock:
            now[0] -= 1
        if key % 50 == 0:
            raise KeyError(key)
        return key * 2

    t = time.perf_counter()
    got = {k: (v, e) for k, v, e in calls_in_flight(range(500), fetch, 10)}
    assert len(got) == 500 and most[0] <= 10 and time.perf_counter() - t < 500 * 0.02 / 4
    assert got[7] == (14, None) and got[50] == (None, "KeyError: 50")
    assert list(calls_in_flight([], fetch, 3)) == []


def test_hanging_call_is_an_error_row(spark):
    def fetch(key):
        import time
        if key == "5":
            time.sleep(30)
        return {"status": key}

    keys = spark.range(200).select(F.col("id").cast("string").alias("k"))
    t = time.perf_counter()
    rows = {r.k: r for r in lookup_batch(keys, "k", fetch, STATUS, max_parallel=1, window=4, timeout_s=0.5).collect()}
    assert time.perf_counter() - t < 20 and len(rows) == 200
    assert rows["5"].status is None and rows["5"].error.startswith("TimeoutError") and rows["6"].status == "6"


def test_lookup_run_asks_no_finished_key_twice(spark, tmp_path):
    log = str(tmp_path / "calls")
    os.makedirs(log)

    def fetch(key):
        with open(os.path.join(log, f"{key}-{time.time_ns()}"), "w"):
            pass
        if key in ("3", "13"):
            raise ValueError("down")
        return {"status": f"s{key}"}

    src, dst, ck = (str(tmp_path / n) for n in ("src", "dst", "ck"))

    def drop(n, lo, hi):
        spark.range(lo, hi).select(F.col("id").cast("string").alias("k")).write.parquet(f"{src}/drop={n}")

    drop(1, 0, 10)
    lookup_run(spark, src, dst, ck, "k", fetch, STATUS, max_parallel=2, window=2)
    drop(2, 5, 20)                                  # 5 to 9 have their answers, 3 and 13 fail
    import shutil
    shutil.move(f"{ck}/commits", str(tmp_path / "commits-gone"))      # as if stopped before the commit
    lookup_run(spark, src, dst, ck, "k", fetch, STATUS, max_parallel=2, window=2)
    calls = Counter(f.split("-")[0] for f in os.listdir(log))
    assert calls == Counter(str(i) for i in range(20))
    out = retry_failed(spark, dst, "k", lambda key: {"status": "again"}, STATUS)
    rows = {r.k: (r.status, r.error) for r in out.collect()}
    assert rows == {str(i): ("again" if i in (3, 13) else f"s{i}", None) for i in range(20)}
    assert read_lookups(spark, dst, "k").where("attempt = 1").count() == 2


@pytest.mark.parametrize("null_equal", [False, True])
def test_merge_outer_split_equals_plain(spark, null_equal):
    rng = random.Random(2)
    left = [(rng.choice([None, 1, 1, 1, 2, 3, 4]), rng.choice([None, "a", "b"]), i) for i in range(60)]
    right = [(rng.choice([None, 1, 2, 2, 5]), rng.choice([None, "a", "c"]), -i) for i in range(40)]
    a = spark.createDataFrame(left, "k int, k2 string, v int").withColumn("m", F.create_map(F.lit("x"), F.col("v")))
    b = spark.createDataFrame(right, "k int, k2 string, v int")
    for on in ("k", ["k", "k2"]):
        plain, split = (merge_outer(a, b, on, null_equal=null_equal, hot_rows=h) for h in (1000, 3))
        assert plain.columns == split.columns
        assert Counter(map(str, plain.collect())) == Counter(map(str, split.collect()))
        n = len([on] if isinstance(on, str) else on)
        pairs = [(x, y) for x in left for y in right if x[:n] == y[:n] and (null_equal or None not in x[:n])]
        alone = sum(not any(x is p[0] for p in pairs) for x in left) + sum(not any(y is p[1] for p in pairs) for y in right)
        assert plain.count() == len(pairs) + alone
    empty = merge_outer(a.limit(0), b, "k", hot_rows=3)
    assert empty.count() == 40


def _copied(df):
    """Rows that the exploding steps of a collected query put out."""
    def walk(node):
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        own = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))
    plan = df._jdf.queryExecution().executedPlan()
    return walk(plan.finalPhysicalPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan)


def test_copies_of_an_outer_merge_do_not_grow_with_its_pairs(spark):
    """80 keys of 25 x 10 rows and a part for each row at least: an even share of the tasks needs few copies."""
    left = spark.range(2_000).select((F.col("id") % 80).alias("k"), F.col("id").alias("x"))
    right = spark.range(800).select((F.col("id") % 80).alias("k"), F.col("id").alias("y"))
    merged = merge_outer(left, right, "k", hot_rows=1)
    assert Counter((r.k, r.x, r.y) for r in merged.collect()) == Counter((x % 80, x, y) for x in range(2_000) for y in range(x % 80, 800, 80))
    assert 0 < _copied(merged) < 10_000         # 40,000 with a part for each pair
    sizes = [(250, 100, 4), (250, 100, 1), (10 ** 6, 3, 128), (3, 10 ** 6, 128), (10 ** 5, 10 ** 5, 128), (40, 40, 128)]
    got = spark.createDataFrame(sizes, "nl long, nr long, parts long").select(*_grid(F.col("nl"), F.col("nr"), F.col("parts"), 10)).collect()
    assert [tuple(r) for r in got] == [(2, 2), (1, 1), (128, 1), (1, 128), (11, 12), (4, 4)]


def test_hot_key_of_an_outer_merge_is_spread(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("x"))
    right = spark.range(3).select(F.lit(1).alias("k"), F.col("id").alias("y"))
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = merge_outer(left, right, "k", hot_rows=400).withColumn("p", F.spark_partition_id())
        per = [r["count"] for r in out.groupBy("p").count().collect()]
        assert sum(per) == 12_000 and len(per) > 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[1])


def test_group_medians_equal_sorted_lists(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["hot", "hot", "hot", "a", "b", None, "one"]), rng.choice([None, 0.0, -0.0, 1.5, rng.random(), float(rng.randint(-3, 3))])) for _ in range(700)]
    rows += [("none", None), ("single", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    want = {}
    for g in {r[0] for r in rows}:
        values = sorted(v for k, v in rows if k == g and v is not None)
        if values:
            want[g] = statistics.median(values)
    for tasks in (1, 3, 40):
        got = {r.g: r.m for r in group_medians(df, "g", "v", "m", tasks=tasks).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[g], want[g], abs_tol=1e-12) for g in want)
    agg = {r.g: (r.v_median, r.v_count) for r in group_agg(df, "g", {"v": ["median", "count"]}, dropna=False).collect()}
    assert agg["none"] == (None, 0) and math.isclose(agg[None][0], want[None], abs_tol=1e-12)
    only = {r.g: r.v for r in group_agg(df, "g", {"v": "median"}).collect()}
    assert only.keys() == {g for g, _ in rows if g is not None} and only["single"] == 4.0
    assert group_medians(df.limit(0), "g", "v").count() == 0


def test_names_are_found_by_containment(spark):
    rng = random.Random(9)
    texts = [(i, "".join(rng.choice("abAB_% é") for _ in range(rng.randint(0, 12)))) for i in range(300)] + [(300, None), (301, "xyzXYZ"), (301, "xyzXYZ")]
    names = ["ab", "A", "_%", "%", "é", "b_a", "abab", "zx", "XYZx", "nothing here", "", None, "ab", "aB"]
    df = spark.createDataFrame(texts, "seq long, t string")
    ndf = spark.createDataFrame([(n,) for n in names], "name string")
    got = Counter((r.query_name, r.seq) for r in search_names_contains(df, ndf, "t", per=None).collect())
    assert got == Counter((n, i) for n in {n for n in names if n} for i, t in texts if t is not None and n.upper() in t.upper())
    top = search_names_contains(df, ndf, "t", per=2).groupBy("query_name").count().collect()
    assert all(r["count"] <= 2 for r in top)


def _first_join(df):
    """The topmost join of the planned query."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return next(line for line in plan.splitlines() if "Join [" in line)


def test_copies_of_hot_rows_are_never_broadcast(spark):
    """The copies of a hot key's rows are many times what Spark estimates from the side's size."""
    left = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("x"))
    right = spark.range(40).select(F.lit(1).alias("k"), F.col("id").alias("y"))
    merged = merge_outer(left, right, "k", hot_rows=10)
    assert "SortMergeJoin" in _first_join(merged) and "_rl_snl" in _first_join(merged)
    assert merged.count() == 120_000


def test_grams_of_texts_are_never_broadcast(spark):
    """All grams of the texts are many times what Spark estimates from the texts' size."""
    texts = spark.range(50).select(F.col("id").alias("seq"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("t"))
    names = spark.range(50).select(F.concat(F.lit("ext "), F.col("id").cast("string")).alias("name"))
    found = search_names_contains(texts, names, "t", per=None)
    assert "SortMergeJoin [_rl_gram" in _first_join(found)
    assert found.count() == sum(f"ext {i}" in f"text {j}" for i in range(50) for j in range(50))
