import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recordlink.llm.op3_quality import (_text_counts, estimate, quality_filter, quality_report)
from tests.llm.edge import edge_documents, empty_documents

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit)]


def test_counts_equal_brute_force(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += [None, "", " ", "a", "a a a a", "a b c a b c", "x\x1fy z\x85w", "l\n\nl\r\nl\nl ", "# * || <>"]
    count = _text_counts()
    assert [count(t)[:5] for t in texts] == [brute(t) for t in texts]


def test_report_edge(spark):
    docs = edge_documents(spark)
    rows = quality_report(docs).collect()
    want = Counter((r.doc_id, *brute(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_empty(spark):
    assert quality_report(empty_documents(spark)).count() == 0
    assert quality_filter(empty_documents(spark)).count() == 0


def test_filter_keeps_columns_and_agrees(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit(7))
    kept = quality_filter(docs)
    assert kept.columns == docs.columns
    want = {r.doc_id for r in quality_report(docs).filter("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want


def test_accuracy_on_labels(spark):
    """Labels are never used to fit: all of them are held out."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_report(docs).join(labels, "doc_id").filter("not base_failed").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)


def test_estimate_recovers_rates():
    import random
    rng, counts = random.Random(3), Counter()
    truth = [(0.8, 0.02), (0.6, 0.05), (0.7, 0.01), (0.5, 0.1)]
    for _ in range(40_000):
        good = rng.random() < 0.85
        counts["".join("-" if rng.random() < 0.1 else "10"[rng.random() < (f if good else b)] for b, f in truth)] += 1
    prior, rates = estimate(counts)
    assert prior == pytest.approx(0.85, abs=0.02)
    for (b, f), (x, y) in zip(truth, rates):
        assert x == pytest.approx(b, abs=0.06) and y == pytest.approx(f, abs=0.03)
