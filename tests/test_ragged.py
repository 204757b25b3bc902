"""Ragged JSON records kept as VARIANT."""

from pyspark.sql import functions as F

from recordlink.sources import ragged as G


def test_layouts_wrappers_and_broken_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": "x"}\n{broken\n[{"id": 2}, 3]\n{"data": [{"id": 4}]}\n{"data": 5}\nnull\n')
    (tmp_path / "b.json").write_text('{"data": [\n {"id": 6},\n {"id": {"n": 7}}\n]}')
    (tmp_path / "c.json").write_text("")
    got = G.read_records(spark, str(tmp_path))
    texts = sorted(r.t for r in got.where(F.col("_corrupt_record").isNull()).select(F.to_json("record").alias("t")).collect())
    assert texts == sorted(['{"id":1}', '{"id":"x"}', '{"id":2}', "3", '{"id":4}', '{"data":5}', "null", '{"id":6}', '{"id":{"n":7}}'])
    assert [r._corrupt_record for r in got.where(F.col("_corrupt_record").isNotNull()).collect()] == ["{broken"]


def test_paths_and_shredding(spark):
    texts = ['{"a": 1, "b c": true, "d": {"e": {"f": "x", "g": {"h": 1}}}}', '{"a": 1.5, "b c": null, "d": 2}', '{"a": "1", "it\'s": 1}', "7", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "a_number int, t string").select(
        "a_number", F.parse_json("t").alias("record"))
    kinds = {r.path: {k for k in G.KINDS if r[f"n_{k}"]} for r in G.path_types(df).collect()}
    assert kinds == {"$.a": {"integer", "number", "string"}, "$['b c']": {"boolean", "null"}, "$.d": {"object", "integer"},
                     "$.d.e": {"object"}, "$.d.e.f": {"string"}, "$.d.e.g": {"object"}, "$[\"it's\"]": {"integer"}}
    out = G.shred(df, min_share=0.2)
    rows = {r.a_number: r.asDict() for r in out.drop("record").collect()}
    assert [rows[i]["a_number_2"] for i in range(5)] == [1.0, 1.5, None, None, None]      # the name a_number is taken
    assert rows[2]["a_string"] == "1" and rows[0]["b_c_boolean"] is True and rows[0]["d_e_f_string"] == "x"
    assert rows[1]["d_integer"] == 2 and rows[2]["it_s_integer"] == 1
    assert G.shred(df, min_share=0.5).columns == ["a_number", "record", "a_number_2"]
    assert G.shred(df.limit(0)).columns == ["a_number", "record"]


def test_get_path_defaults(spark):
    df = spark.createDataFrame([('{"a": {"b": "12"}}',), ('{"a": 1}',), (None,)], "t string").select(F.parse_json("t").alias("record"))
    assert [r[0] for r in df.select(G.get_path("record", "$.a.b", "int", -1)).collect()] == [12, -1, -1]
