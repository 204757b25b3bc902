"""The audit against counting by hand, and its registered query against SQL."""
import re
from collections import defaultdict
from itertools import permutations

import duckdb
import numpy as np
from pyspark.sql import functions as F

from recordlink.llm import op11_filter_audit as op
from tests.llm.edge import edge_documents, empty_documents

SF = "/root/testdata/sf0.01"


def _expected(docs, labels):
    low = {}
    for i, t, _ in docs:
        if i is not None:
            low[t or ""] = min(i, low.get(t or "", i))
    good, toxic = ({i for i, *marks in labels if marks[k] == 1} for k in (0, 1))
    fails = []
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {x for x, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                                           bool(re.search("[#$%&*|]", t)), i is not None and low[t] < i)) if bad}
        fails.append((s or "", f, i is not None and i in good, i is not None and i in toxic))
    out = {}
    for part in {f[0] for f in fails}:
        share = defaultdict(int)
        for order in permutations("ABCDE"):
            left = [f for f in fails if f[0] == part]
            gone = []
            for step, x in enumerate(order, 1):
                hit = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                out[part, "".join(order), step] = [len(left), len(hit), sum(x in f[1] for f in gone), sum(f[0] == part and f[1] == {x} for f in fails),
                                                   sum(f[2] for f in hit), sum(f[3] for f in hit)]
                gone += hit
                share[x] += len(hit)
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                out[part, "".join(order), step].append(share[x])
    return {k: tuple(v) for k, v in out.items()}


def _got(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(got) == len(rows)
    return got


def _tables(spark):
    long = " ".join(f"w{i}" for i in range(300))
    more = [(20 + i, long, "hot") for i in range(40)] + [(70, long + " A&B", "hot"), (71, long.upper(), None), (72, long.upper(), "")]
    more += [(80, "same id", "a"), (80, "same id", "a"), (80, "same id", "b"), (80, long, "b"), (None, long, "b")]
    docs = edge_documents(spark).unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"), allowMissingColumns=True)
    docs = docs.select("*", F.lit(1).alias("hash"), F.lit(1).alias("mask"), F.lit("z").alias("filter_order")).repartition(6)
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 1), (6, 0, 0), (22, 1, None), (80, None, 1), (None, 1, 1), (999, 1, 1)],
                                   "doc_id long, quality int, toxic int").withColumn("part", F.lit("p"))
    return docs, labels


def test_audit_equals_counting_by_hand(spark):
    docs, labels = _tables(spark)
    want = _expected([(r.doc_id, r.text, r.source) for r in docs.collect()], [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])
    assert _got(op.filter_audit(docs, labels)) == want
    # a sketch far too small takes every text for a possible repeat: the result is the same
    assert _got(op.audit(op.mask_counts(op.failure_masks(docs, most_slots=64), labels))) == want


def test_empty_tables(spark):
    docs, labels = _tables(spark)
    assert op.filter_audit(empty_documents(spark), labels).count() == 0
    assert all(v[4] == v[5] == 0 for v in _got(op.filter_audit(docs, labels.limit(0))).values())


def test_sketch_clears_unique_texts_only(spark):
    rng = np.random.default_rng(1)
    once = rng.integers(-2**62, 2**62, 20_000)
    twice = rng.integers(-2**62, 2**62, 500)
    flags = spark.createDataFrame([(int(h),) for h in [*once, *twice, *twice]], "hash long").repartition(7)
    bits, slots = op.repeat_sketch(flags, 21_000)
    may = op._may_repeat(spark, bits, slots)
    kept = {r.hash for r in flags.filter(may("hash")).distinct().collect()}
    assert kept >= set(map(int, twice)) and len(kept) < 500 + 400


def test_query_equals_sql(spark):
    from recordlink.llm.registry import ORACLE, op11_filter_audit
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert sorted(map(tuple, op11_filter_audit(spark, SF).collect())) == sorted(con.execute(ORACLE["op11_filter_audit"]).fetchall())
