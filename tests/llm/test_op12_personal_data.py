"""Base spans against the plain patterns, the field against enumeration and held-out spellings."""
import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from recordlink.llm import op12_personal_data as op
from tests.llm.edge import edge_documents, empty_documents

SF = "/root/testdata/sf0.01"
WORDS = "the and with from near about office please und der die le la for".split()
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain(text):
    """Base spans as the contract says them."""
    out = {}
    for kind, pattern in PATTERNS.items():
        out[kind] = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = "".join(str(int(c) * (1 + k % 2) // 10 + int(c) * (1 + k % 2) % 10) for k, c in enumerate(reversed(digits)))
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and sum(map(int, double)) % 10 == 0, "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out[kind].append(m.span())
    return out


@pytest.fixture(scope="module")
def model():
    return op.fit_field(op._examples(1, 60, WORDS))


def test_base_spans_equal_the_patterns():
    rng, find = random.Random(2), op.base_finder()
    pieces = ["ann@x.org", "a.b+c@d-e.co.uk", "@", "a@b", "a@@b.c", "1.2.3.4", "1.2.3.400", "001.02.3.4.5.6.7.8.9", "4111 1111 1111 1111", "4111-1111-1111-1112",
              "378282246310005", "+1 (743) 555-3824", "+49", "+12345678 ", "+1....2", "x", " ", "-", ".", "5", "00", "é", "\n", "%", "6011000990139424", "١٢٣"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert find(text) == _plain(text), text
    assert find(None) == _plain("")


def _best_by_enumeration(text, model):
    """Best segmentation of a window by trying every set of segments apart."""
    _, tokens, segments = op.span_reader()
    toks = tokens(text, 0, len(text))
    cands = [(i, j, k, sum(model["weights"].get(x, [0] * 4)[k] for x in f)) for i, j, kinds, f in segments(text, toks) for k in kinds]

    def score(path):
        at, was, total = 0, 0, 0.0
        for i, j, k, s in path:
            for _ in range(i - at):
                total += model["moves"][was][0]
                was = 0
            total += model["moves"][was][k + 1] + s
            at, was = j, k + 1
        for _ in range(len(toks) - at):
            total += model["moves"][was][0]
            was = 0
        return total

    best = [(score([]), [])]

    def grow(path, at):
        for c in cands:
            if c[0] >= at:
                best[0] = max(best[0], (score([*path, c]), [*path, c]), key=lambda b: b[0])
                grow([*path, c], c[1])

    grow([], 0)
    return {(op.KINDS[k], toks[i][1], toks[j - 1][2]) for i, j, k, _ in best[0][1]}


def test_decoding_equals_enumeration(model):
    _, tokens, _ = op.span_reader()
    find = op.span_finder(model)
    texts = ["call (212) 555-0100 4111.1111.1111.1111", "ann (at) example dot org", "10[.]0[.]0[.]7 or 2020-10-12", "(1) 234 5678 90",
             "bob [at] x.org amy @ y.net"]
    for text in texts:
        assert {s[:3] for s in find(text)} == _best_by_enumeration(text, model), text


def test_gradient_moves_to_the_gold_segmentation():
    text = "abc 12-34-567 xyz"
    for kind in (1, 2, 3):
        m = op.fit_field([(text, [(4, 13, kind)])] * 3)
        assert [(k, a, b) for k, a, b, _ in op.span_finder(m)(text)] == [(op.KINDS[kind], 4, 13)]
    m = op.fit_field([(text, [])] * 3 + [("abc (555) 123-4567", [(4, 18, 3)])])
    assert op.span_finder(m)(text) == []


def test_held_out_spellings(model):
    find, right, wrong, missed = op.span_finder(model), 0, 0, 0
    for seed in (77, 78):
        for text, gold in op._examples(seed, 60, WORDS):
            want = {(op.KINDS[k], a, b) for a, b, k in gold}
            got = {s[:3] for s in find(text)}
            right, wrong, missed = right + len(want & got), wrong + len(got - want), missed + len(want - got)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.97


def test_numbers_run_together_are_told_apart(model):
    text = "see +1 (269) 555-3296 4539578763621486 then 10.1.2.3 4539578763621486."
    assert _plain(text)["phone"] == _plain(text)["card"] == []       # one over-long match each
    found = {(k, text[a:b]) for k, a, b, _ in op.span_finder(model)(text)}
    assert found == {("phone", "+1 (269) 555-3296"), ("card", "4539578763621486"), ("ip", "10.1.2.3")}


def test_time_grows_with_the_text(model):
    find = op.span_finder(model)
    for piece in ("a@", "5", "+1 ", " at x.y", "(1) ", "12 34 ", "[at]", "a", "1.1.1.", "at dot "):
        took = []
        for n in (10_000, 40_000):
            t = time.perf_counter()
            find(piece * (n // len(piece)))
            took.append(time.perf_counter() - t)
        assert took[1] < 8 * took[0] + 0.5, piece


def test_query_on_the_table(spark):
    from recordlink.llm.registry import op12_personal_data
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = op12_personal_data(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = _plain(texts[r.doc_id])
        names = [f"{k}:{a}:{b}" for k in op.KINDS for a, b in base[k]]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in op.KINDS)
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(names) <= set(spans) and len(spans) == len(names) + r.n_added
        keyed = [(op.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert keyed == sorted(keyed)
    assert sum(r.n_added for r in rows) < 0.02 * len(rows)


def test_edge_documents(spark, model):
    more = spark.createDataFrame([(50, "ann at mail dot example dot org 東京 +1 (743) 555-3824"), (50, "ann at mail dot example dot org 東京 +1 (743) 555-3824"),
                                  (51, "0" * 300_000), (52, "é" * 70_000 + " x@y.zz")], "doc_id long, text string")
    docs = edge_documents(spark).unionByName(more, allowMissingColumns=True).select("*", F.lit(1).alias("spans"), F.lit(2).alias("n_ip"))
    docs = docs.repartition(4)
    got = op.personal_report(docs, model).collect()
    assert len(got) == docs.count()
    assert {r.spans for r in got if r.doc_id == 50} == {"email:0:31,phone:35:52"} and [r.spans for r in got if r.doc_id == 52] == ["email:70001:70007"]
    assert all(r.spans == "" and r.base_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id in (2, 3, 4, 51, None))
    clean = op.redact_personal(docs, model)
    assert clean.columns == docs.columns and {r.text for r in clean.filter("doc_id = 50").collect()} == {"[email] 東京 [phone]"}
    assert clean.filter("text is null").count() == docs.filter("text is null").count()
    assert op.personal_report(empty_documents(spark)).count() == 0
    trained = op.train(docs, each=5)
    assert set(trained) == {"weights", "moves"}
