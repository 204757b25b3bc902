"""Small hand-made cases: falsy values, ties, collisions and kept quirks."""

import pytest
from pyspark.sql import functions as F

from recordlink.functions import expr as X
from recordlink.operators import combine as C
from recordlink.operators import dedup as D
from recordlink.operators import outlets as O
from recordlink.operators import places as P
from recordlink.operators import quality as Q
from recordlink.operators import schema as S
from recordlink.operators.batches import union_all


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else \
        sorted(tuple(r) for r in df.collect())


def test_field_names():
    assert S.normalize_field_name("zipcode") == "zip_code"
    assert S.normalize_field_name("TaxpayerNumber") == "taxpayer_id"
    assert S.normalize_field_name("businessName") == "business_name"
    assert S.normalize_field_name("Zip") == "zip_code"
    assert S.normalize_field_name("someFieldName") == "some_field_name"
    assert S.camel_to_snake("HTTPResponseCode") == "http_response_code"


def test_truthy_per_type(spark):
    df = spark.createDataFrame(
        [("", 0, False, [], " "), (None, None, None, None, None), ("a", 2, True, [1], "x")],
        "s string, n int, b boolean, a array<int>, w string")
    got = [tuple(r) for r in df.select(*[X.truthy_of(df, c).alias(c) for c in df.columns]).collect()]
    assert got[0] == (False, False, False, False, True)   # whitespace-only is truthy
    assert got[1] == (False, False, False, False, False)
    assert got[2] == (True, True, True, True, True)


def test_normalize_collision_last_truthy(spark):
    df = spark.createDataFrame([("1", "A", "", "x"), ("2", "", "B", ""), ("3", "", "", "")],
                               "seq string, zip string, zipcode string, ZipCode string")
    n = S.normalize(df, keep=["seq"])
    assert n.columns == ["seq", "zip_code"]
    assert rows(n) == [("1", "x"), ("2", "B"), ("3", "")]


def test_case_colliding_columns(spark):
    df = spark.createDataFrame([("12345678901", "", "1"), ("", "99999999999", "2")],
                               "TaxpayerID string, taxpayerid string, seq string")
    n = S.normalize(df, keep=["seq"])
    assert n.columns == ["taxpayer_id", "seq"]
    assert rows(n) == [("12345678901", "1"), ("99999999999", "2")]
    acc = spark.createDataFrame([("1", "12345678901", "x")], "seq string, taxpayer_id string, s string")
    c = C.combine(df, acc)
    # the key lookup keeps the last spelling (empty in row 1), so row 1 has no key
    assert rows(c, "taxpayer_id", "has_registry_data", "has_account_data") == [
        ("12345678901", False, True), ("99999999999", True, False)]


def test_resolve_key_no_fallback(spark):
    df = spark.createDataFrame([("12-3", "32000000001"), ("", "32000000002"), (None, None)],
                               "taxpayer_id string, taxpayer_number string")
    got = [r[0] for r in df.select(S.resolve_key(df).alias("k")).collect()]
    assert got == [None, "32000000002", None]


def test_key_helpers(spark):
    df = spark.createDataFrame([("78701-1234", "512-555-0199", "a.b@c.org"),
                                ("7870", "5551234", "bad@"), ("123456", "", "x@y.zz\n")],
                               "z string, p string, e string")
    got = df.select(X.format_zip("z"), X.valid_zip("z"), X.format_phone("p"), X.valid_email("e")).collect()
    assert tuple(got[0]) == ("78701-1234", True, "(512) 555-0199", True)
    assert tuple(got[1]) == (None, False, "5551234", False)
    assert tuple(got[2]) == ("12345", False, None, True)   # `$` accepts one trailing newline


def test_combine_reference_shape(spark):
    a = spark.createDataFrame([(1, "12345678901", "Business A", "Austin"),
                               (2, "45678901234", "Business B", "Dallas")],
                              "seq int, taxpayer_id string, name string, city string")
    b = spark.createDataFrame([(1, "12345678901", "active", "2023"),
                               (2, "78901234567", "inactive", "2023")],
                              "seq int, taxpayer_id string, status string, year string")
    c = C.combine(a, b)
    got = rows(c, "taxpayer_id", "has_registry_data", "has_account_data", "data_source")
    assert got == [("12345678901", True, True, "account"), ("45678901234", True, False, "registry"),
                   ("78901234567", False, True, "account")]
    assert "registry_business_name" in c.columns and "account_status" in c.columns
    s = C.combine_stats(c).first()
    assert (s.total_records, s.with_both_sources, s.only_registry, s.only_account) == (3, 1, 1, 1)


def test_combine_last_row_wins(spark):
    a = spark.createDataFrame([(1, "12345678901", "old"), (2, "123-456-78901", "new"), (3, "123", "bad")],
                              "seq int, taxpayer_id string, name string")
    b = spark.createDataFrame([(1, "99999999999", "x")], "seq int, taxpayer_id string, status string")
    got = rows(C.combine(a, b), "taxpayer_id", "registry_business_name")
    assert got == [("12345678901", "new"), ("99999999999", None)]


def test_dedup_key_and_stats(spark):
    df = spark.createDataFrame([(1, "123", "A"), (2, "456", "B"), (3, " 123 ", "A2"), (4, "", "C"),
                                (5, "789", "D")], "seq int, taxpayer_id string, name string")
    f = D.dedup(df)
    assert rows(D.unique(f), "seq") == [(1,), (2,), (4,), (5,)]
    assert rows(D.duplicates(f), "seq") == [(3,)]
    s = D.dedup_stats(f).first()
    assert (s.original_count, s.unique_count, s.duplicate_count) == (5, 4, 1)
    assert s.deduplication_rate == pytest.approx(20.0)


def test_dedup_fuzzy_whitespace_quirk(spark):
    df = spark.createDataFrame([(1, "X1", " "), (2, "x1 ", "\t"), (3, None, "")],
                               "seq int, taxpayer_id string, name string")
    f = D.dedup(df, "fuzzy", with_key="k")
    assert rows(f, "seq", "k", "is_duplicate") == [(1, "|x1", False), (2, "|x1", True), (3, None, False)]


def test_dedup_exact_type_sensitive(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "a", None), (4, None, None)],
                               "seq int, s string, n int")
    f = D.dedup(df, "exact")
    assert rows(D.duplicates(f), "seq") == [(2,)]


def test_merge_duplicates_rules(spark):
    df = spark.createDataFrame([
        (1, "K", "ab", "", None),
        (2, "K", "xyz", "", "q"),
        (3, "K", "uvw", None, ""),
        (4, "L", "only", "z", "y"),
        (5, "", "nokey", "", ""),
    ], "seq int, taxpayer_id string, name string, city string, zip string")
    m = {r.seq: r for r in D.merge_duplicates(df).collect()}
    k = m[1]
    assert (k.name, k.city, k.zip, k._merged_from_count) == ("xyz", None, "q", 3)  # tie -> earliest
    assert (m[4].name, m[4]._merged_from_count) == ("only", None)
    assert m[5].name == "nokey"
    # all falsy -> the last value of the group (None from row 3)
    assert k.city is None


def test_best_by_completeness(spark):
    df = spark.createDataFrame([(1, "K", "a", None), (2, "K", "a", "long value here"), (3, "K", "b", "c")],
                               "seq int, taxpayer_id string, x string, y string")
    got = rows(D.best_by_completeness(df), "seq", "completeness_score")
    assert got == [(2, 4)]   # order column not scored


def test_detect_duplicates_null_is_a_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a"), (5, "b")],
                               "seq int, taxpayer_id string")
    assert rows(D.detect_duplicates(df, "taxpayer_id"), "seq") == [(2,), (4,)]


def test_outlets(spark):
    src = spark.createDataFrame([
        (1, "12345678901", "Business A", "001", "Austin"),
        (2, "12345678901", "Business A", "002", "Round Rock"),
        (3, "45678901234", "Business B", "003", ""),
    ], "seq int, taxpayer_id string, taxpayer_name string, outlet_number string, outlet_city string")
    outl = O.collect_outlets(src)
    counts = dict((r[0], r[1]) for r in outl.groupBy("taxpayer_id").count().collect())
    assert counts == {"12345678901": 2, "45678901234": 1}
    base = spark.createDataFrame([(10, "12345678901", "Business A"), (11, "45678901234", "Business B")],
                                 "seq int, taxpayer_id string, taxpayer_name string")
    a = {r.taxpayer_id: r for r in O.attach_outlets(base, outl).collect()}
    assert (a["12345678901"].outlet_number, a["12345678901"].outlet_count) == ("001", 2)
    assert (a["45678901234"].outlet_number, a["45678901234"].outlet_city) == ("003", None)
    m = {r.taxpayer_id: r for r in O.attach_merged_outlets(base, outl).collect()}
    assert (m["12345678901"].outlet_count, m["45678901234"].outlet_count) == (2, None)


def test_validate_messages(spark):
    df = spark.createDataFrame([("123", " 7870", "bad@", ""), ("12345678901", "78701-1234", None, "n")],
                               "taxpayer_id string, zip string, email string, name string")
    v = Q.validate(df, required=["name"]).collect()
    assert v[0].errors == ["Missing required field: name", "Invalid taxpayer ID format",
                           "Invalid ZIP code:  7870", "Invalid email: bad@"]
    assert v[1].errors == [] and v[1].is_valid


def test_clean(spark):
    df = spark.createDataFrame([(" 12-34 ", " 78701-1234", "512.555.0199", "  x  ", "")],
                               "taxpayer_id string, zip string, phone string, name string, e string")
    r = Q.clean(df).first()
    assert tuple(r) == ("1234", "78701", "(512) 555-0199", "x", None)


def test_search_query_and_place_transform(spark):
    df = spark.createDataFrame([("A & B's", None, "Austin", "", "78701"), (None, None, None, None, None)],
                               "taxpayer_name string, taxpayer_address string, taxpayer_city string, "
                               "taxpayer_state string, taxpayer_zip string")
    got = [r[0] for r in df.select(P.search_query(df)).collect()]
    assert got == ["A & B's Austin TX 78701", "TX"]
    resp = spark.createDataFrame(
        [(("Cafe", "en"), "PRICE_LEVEL_MODERATE", (30.1, -97.7))],
        "displayName struct<text:string,languageCode:string>, priceLevel string, "
        "location struct<latitude:double,longitude:double>")
    t = P.transform_place(resp).first()
    assert (t.name, t.price_level, t.geometry.location.lat) == ("Cafe", 2, 30.1)


def test_flatten_unflatten(spark):
    df = spark.createDataFrame([(1, ("n", (2.0,)))], "id int, info struct<name:string,bal:struct<amt:double>>")
    f = S.flatten(df)
    assert f.columns == ["id", "info_name", "info_bal_amt"]
    u = S.unflatten(f)
    assert u.first().info.bal.amt == 2.0
    clash = spark.createDataFrame([(1, 2)], "a int, a_b int")
    with pytest.raises(ValueError):
        S.unflatten(clash)


def test_union_type_clash(spark):
    a = spark.createDataFrame([(1, 5)], "id int, n int")
    b = spark.createDataFrame([(2, "x")], "id int, n string")
    u = union_all({"a": a, "b": b}, tag="src")
    assert dict(u.dtypes)["n"] == "string"
    assert rows(u, "id", "n", "src") == [(1, "5", "a"), (2, "x", "b")]


def test_merge_outer_suffixes(spark):
    l = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    r = spark.createDataFrame([(1, "b"), (2, "c"), (None, "m")], "k int, v string")
    m = C.merge_outer(l, r, "k")
    assert set(m.columns) == {"k", "v_x", "v_y"}
    assert m.count() == 4
    assert C.merge_outer(l, r, "k", null_equal=True).count() == 3


def test_new_records_keeps_keyless(spark):
    df = spark.createDataFrame([(1, "12345678901"), (2, "12345678901"), (3, ""), (4, "99999999999")],
                               "seq int, taxpayer_id string")
    ex = spark.createDataFrame([("99999999999",)], "taxpayer_id string")
    assert rows(C.new_records(df, ex), "seq") == [(1,), (3,)]


# --- rows with awkward order values, maps and repeats --------------------------------------------

def test_flag_first_null_and_repeated_order(spark):
    from recordlink.operators import dedup as D
    rows = [("A", 1, "x"), ("B", 1, "x"), ("A", 2, "y"), ("C", None, "x"), ("C", None, "y"), ("D", 5, "p"), ("D", 5, "q"),
            ("E", 7, "same"), ("E", 7, "same"), (None, None, "n"), (None, 1, "n"), ("F", None, "z"), ("F", 3, "z")]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    for keep in ("first", "last"):
        u = D.unique(D.flag_first(df, F.col("k"), "seq", keep=keep)).collect()
        assert sorted(r.k for r in u if r.k) == list("ABCDEF")
        assert sum(r.k is None for r in u) == 2
    assert [r.seq for r in u if r.k == "A"] == [2]
    u = D.unique(D.flag_first(df, F.col("k"), "seq", null_keys="group")).collect()
    assert sorted(str(r.k) for r in u) == sorted(["None", *"ABCDEF"])


def test_hot_key_without_order_spreads(spark):
    from recordlink.operators import dedup as D
    df = spark.range(30_000).select((F.col("id") % 3).alias("k"), F.lit(None).cast("int").alias("seq"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flagged = D.flag_first(df, F.col("k"), "seq").withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in flagged.groupBy("task").count().collect()]
        plan = flagged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sizes) < 9_000
    assert plan.count("Exchange") == 3          # keys, places, rows; none for the ties
    assert D.unique(flagged).count() == 3


def test_merge_maps_with_null(spark):
    from recordlink.operators.schema import merge_maps
    df = spark.sql("SELECT * FROM VALUES (map('a', 1), map('a', 2, 'b', 3)), (map('a', 1), null), (null, map('b', 2)), (null, null) AS t(x, y)")
    got = [r[0] for r in df.select(merge_maps(F.col("x"), F.col("y"))).collect()]
    assert got == [{"a": 2, "b": 3}, {"a": 1}, {"b": 2}, None]


def test_new_records_null_order(spark):
    from recordlink.operators.combine import new_records
    df = spark.createDataFrame([("A", None), ("A", 2), ("B", None), ("C", 1), (None, None)], "taxpayer_id string, seq int")
    old = spark.createDataFrame([("C",)], "taxpayer_id string")
    out = new_records(df, old, key=F.col("taxpayer_id")).collect()
    assert sorted(str(r.taxpayer_id) for r in out) == ["A", "B", "None"]


def test_exact_strategy_ignores_map_entry_order(spark):
    from recordlink.operators import dedup as D
    df = spark.sql("select 1 as seq, map('a', 1, 'b', 2) as m, array(map('x', 1, 'y', 2)) as l union all "
                   "select 2, map('b', 2, 'a', 1), array(map('y', 2, 'x', 1))")
    assert D.unique(D.dedup(df, "exact")).count() == 1
    assert D.unique(D.dedup(df, "hash")).count() == 1


def test_merge_duplicates_keeps_order_columns_together(spark):
    from recordlink.operators import dedup as D
    df = spark.createDataFrame([("k", 1, 9), ("k", 2, 1)], "taxpayer_id string, a int, b int")
    r = D.merge_duplicates(df, order_by=["a", "b"]).first()
    assert (r.a, r.b) == (1, 9)


def test_merge_maps_later_wins(spark):
    from recordlink.operators.schema import merge_maps
    r = spark.sql("select map('a', 1, 'b', 2) x, map('b', 3, 'c', 4) y").select(merge_maps(F.col("x"), F.col("y")).alias("m")).first()
    assert r.m == {"a": 1, "b": 3, "c": 4}


def test_salted_join_with_map_column_and_null_keys(spark):
    from recordlink.operators.skew import salted_join
    big = spark.sql("select * from values ('a', map('x', 1)), ('a', map('y', 2)), (cast(null as string), map('z', 3)) t(k, m)")
    small = spark.createDataFrame([("a", 10)], "k string, v int")
    for how, n in (("left", 3), ("inner", 2), ("left_semi", 2), ("left_anti", 1)):
        for unique in (False, True):
            assert salted_join(big, small, "k", how, hot_rows=1, big_unique=unique).count() == n, how


def test_validation_errors_any_limit(spark):
    from recordlink.operators import quality as Q
    v = spark.range(0, 12_000).selectExpr("id * 2 as seq", "id % 2 = 0 as is_valid")
    rows = Q.validation_errors(v, "seq", limit=5_500).collect()
    assert len(rows) == 5_500 and all(r.record_index * 2 == r.seq for r in rows)


def test_places_last_response_wins(spark):
    from recordlink.operators.places import place_details
    req = spark.createDataFrame([("p1",)], "place_id string")
    resp = spark.createDataFrame([("p1", "old", 1), ("p1", "new", 2)], "place_id string, websiteUri string, seq int")
    row = place_details(req, resp).first().asDict()
    assert "new" in row.values() and "old" not in row.values()


def test_camel_to_snake():
    from recordlink.operators.schema import camel_to_snake
    for name, want in (("TaxPayerID", "tax_payer_id"), ("taxpayerNumber", "taxpayer_number"), ("HTTPServer2Go", "http_server2_go"),
                       ("already_snake", "already_snake"), ("A", "a"), ("", ""), ("zipCode5", "zip_code5")):
        assert camel_to_snake(name) == want
