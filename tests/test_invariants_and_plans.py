"""Invariants (partitioning, idempotence, skew) and physical-plan shape."""

import pytest
from pyspark.sql import functions as F

from recordlink.operators import combine as C
from recordlink.operators import dedup as D
from recordlink.plans.catalog import Catalog
from recordlink.plans.fixtures import fx_account, fx_registry
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_unique_plus_duplicates_is_input(spark):
    reg = fx_registry(Catalog(spark, SF_SMALL))
    f = D.dedup(reg).cache()
    assert D.unique(f).count() + D.duplicates(f).count() == reg.count()


def test_dedup_idempotent(spark):
    reg = fx_registry(Catalog(spark, SF_SMALL))
    once = D.unique(D.dedup(reg))
    twice = D.unique(D.dedup(once))
    assert _sorted(once, "seq") == _sorted(twice, "seq")


def test_repartition_invariance(spark):
    reg = fx_registry(Catalog(spark, SF_SMALL))
    a = D.merge_duplicates(reg)
    b = D.merge_duplicates(reg.repartition(13, F.rand(7)))
    cols = ["seq", "outlet_name", "outlet_number", "_merged_from_count"]
    assert _sorted(a, *cols) == _sorted(b, *cols)


def test_hot_key_third_of_rows(spark):
    """One key holds a third of all rows: results stay whole and plans use
    aggregates (no window partitioned by the key)."""
    n = 30000
    df = spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit("32000000001"))
        .otherwise(F.concat(F.lit("3"), F.lpad((F.col("id") % 5000).cast("string"), 10, "0")))
        .alias("taxpayer_id"),
        (F.col("id") % 17).cast("string").alias("name"))
    f = D.dedup(df)
    # the only window is the tie-break inside one (key, order) pair
    assert all("_rl_place" in x for x in _plan(f).splitlines() if "Window [" in x)
    assert D.unique(f).count() == 1 + len({("3" + str(i % 5000).zfill(10)) for i in range(n) if i % 3})
    m = D.merge_duplicates(df)
    assert "Window" not in _plan(m)
    hot = m.where(F.col("taxpayer_id") == "32000000001").first()
    assert hot._merged_from_count == n // 3
    assert D.duplicate_groups(df).count() == n   # every key repeats
    b = D.best_by_completeness(df)
    assert b.count() == D.unique(f).count()


def test_combine_two_exchanges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cat = Catalog(spark, SF_SMALL)
        reg, acc = fx_registry(cat), fx_account(cat)
        c = C.combine(reg, acc)
        plan = _plan(c)
        ex = "Exchange hashpartitioning"
        own = plan.count(ex) - _plan(reg).count(ex) - _plan(acc).count(ex)
        # one shuffle per side for the collapse; the full outer join reuses them
        assert own == 2, plan
        assert "SortMergeJoin" in plan and "FullOuter" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_pushed(spark):
    cat = Catalog(spark, SF_SMALL)
    acc = fx_account(cat).where(F.col("entity_type") != "AUTOMOBILE").select("taxpayer_id", "status")
    plan = _plan(acc)
    assert "PushedFilters: [IsNotNull(c_mktsegment), Not(EqualTo(c_mktsegment,AUTOMOBILE))]" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double,c_mktsegment:string>" in plan


def test_hot_key_join_is_salted(spark):
    """A key-aggregate joined back onto rows where one key holds a third of
    them: the salted join spreads that key over several tasks (bound lowered to
    test size) and the result is unchanged."""
    from recordlink.operators.skew import hot_keys, salted_join
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        df = spark.range(n).select(
            F.col("id").alias("seq"),
            F.when(F.col("id") % 3 == 0, F.lit("HOT"))
            .otherwise((F.col("id") % 3000).cast("string")).alias("taxpayer_id"))
        assert [tuple(r) for r in hot_keys(df, "taxpayer_id", 2000).collect()] == [("HOT", 10)]
        g = D.duplicate_groups(df, hot_rows=2000)
        assert g.count() == n
        hot = g.where(F.col("group_key") == "HOT")
        assert hot.count() == n // 3 and {r.group_size for r in hot.select("group_size").distinct().collect()} == {n // 3}
        per_task = [r[1] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) >= 4 and max(per_task) < n // 3 // 2, per_task
        # plain key join for comparison: one task gets the whole hot key
        sizes = df.groupBy("taxpayer_id").count()
        plain = df.join(sizes, "taxpayer_id").where(F.col("taxpayer_id") == "HOT")
        assert max(r[1] for r in plain.groupBy(F.spark_partition_id()).count().collect()) == n // 3
        anti = salted_join(df, sizes.where(F.col("taxpayer_id") != "HOT").select("taxpayer_id"),
                           "taxpayer_id", "left_anti", hot_rows=2000)
        assert anti.count() == n // 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_pick_per_key_methods_agree(spark):
    reg = fx_registry(Catalog(spark, SF_SMALL))
    k = D.key_strategy_key(reg)
    a = D.pick_per_key(reg, k, F.col("seq"), pick="max", method="aggregate")
    b = D.pick_per_key(reg, k, F.col("seq"), pick="max", method="join")
    assert _sorted(a, "seq", "taxpayer_number") == _sorted(b, "seq", "taxpayer_number")


def test_hot_rows_from_session(spark):
    from recordlink.operators.skew import HOT_ROWS, HOT_ROWS_CONF, hot_rows_of
    df = spark.range(3)
    assert hot_rows_of(df) == HOT_ROWS and hot_rows_of(df, 7) == 7
    spark.conf.set(HOT_ROWS_CONF, "123")
    try:
        assert hot_rows_of(df) == 123
    finally:
        spark.conf.unset(HOT_ROWS_CONF)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    from recordlink.operators.skew import salted_join
    big = spark.range(5000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 2 == 0, F.lit("HOT"))
        .when(F.col("id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise((F.col("id") % 300).cast("string")).alias("k"))
    small = spark.range(0, 400, 2).select(F.col("id").cast("string").alias("k"),
                                          (F.col("id") * 10).alias("v")) \
        .unionByName(spark.createDataFrame([("HOT", -1)], "k string, v long"))
    got = salted_join(big, small, "k", how, hot_rows=100)
    want = big.join(small, "k", how)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)
