import itertools
import math
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from recordlink.llm.encoding import vocabulary_path
from recordlink.llm import op8_jaccard as op8
from recordlink.llm.op3_quality import quality_report
from recordlink.llm.op6_secrets import secret_scanner
from recordlink.llm.op7_sampling import decode, make_sampler, sample_encodings
from recordlink.llm.op8_jaccard import components, jaccard_components, one_per_component
from tests.llm.edge import edge_documents, empty_documents

MODEL = vocabulary_path("piece_bpe_32k.model")


# --- sampled segmentations ---------------------------------------------------------------------

def _all_segmentations(text):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = {sp.id_to_piece(i): i for i in range(259, sp.get_piece_size())}
    logs = {p: -math.log(3 - sp.get_score(i)) for p, i in ids.items()}
    z = math.log(sum(math.exp(v) for v in logs.values()))
    whole = "▁" + text.replace(" ", "▁")
    out = {}
    for cuts in itertools.product((0, 1), repeat=len(whole) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(whole)]
        parts = [whole[a:b] for a, b in zip(at, at[1:])]
        if all(p in ids for p in parts):
            out[tuple(ids[p] for p in parts)] = sum(logs[p] - z for p in parts)
    total = math.log(sum(math.exp(v) for v in out.values()))
    return {k: v - total for k, v in out.items()}


def test_samples_are_distinct_ordered_and_fair():
    text, n = "the cat", 3000
    want = _all_segmentations(text)
    got = make_sampler(MODEL, 2, 5)([text] * n, list(range(n)))
    firsts, weight = Counter(), defaultdict(float)
    for found in got:
        assert len({tuple(f[0]) for f in found}) == 2
        for ids, log_p, log_q in found:
            assert log_p == pytest.approx(want[tuple(ids.tolist())], abs=1e-9) and log_q <= 0
            weight[tuple(ids.tolist())] += math.exp(log_p - log_q) / n      # estimates each probability
        firsts[tuple(found[0][0].tolist())] += 1
    for s, lp in want.items():
        p = math.exp(lp)
        assert abs(firsts[s] / n - p) <= 4.5 * math.sqrt(p * (1 - p) / n) + 1e-3
    assert sum(weight.values()) == pytest.approx(1.0, abs=0.05)             # inclusion weights are unbiased


def test_samples_do_not_depend_on_the_lattices_kept():
    texts = ["", None, "the cat", "a\0b c\0", "two  blanks   and\n\nlines\n", "▁▁x ▁", "\n", " ", "é漢字🙂 ok", "\0", "x" * 70_000]
    kept, small = make_sampler(MODEL, 2, 0), make_sampler(MODEL, 2, 0, lattice_points=10)
    want = kept(texts, list(range(len(texts))))
    for again in (kept(texts, list(range(len(texts)))), [small([t], [i])[0] for i, t in enumerate(texts)]):
        for x, y in zip(want, again):
            assert [f[0].tolist() for f in x] == [f[0].tolist() for f in y]
            assert [f[1] for f in x] == pytest.approx([f[1] for f in y])


def test_texts_of_a_block_go_down_together():
    """One descent a path for all texts, and the samples that each text has alone."""
    rng, calls = random.Random(3), []
    texts = [" ".join(rng.choice(("encoding", "sampled", "lattices\n", "é☃", "  twice", "nul\0l")) for _ in range(rng.randrange(9))) for _ in range(40)]
    draw = make_sampler(MODEL, 3, 5)
    sys.setprofile(lambda frame, event, _: event == "call" and frame.f_code.co_name == "descend" and calls.append(1))
    try:
        got = draw(texts, list(range(40)))
    finally:
        sys.setprofile(None)
    assert 1 <= len(calls) <= 3
    for i, t in enumerate(texts):
        alone = make_sampler(MODEL, 3, 5)([t], [i])[0]
        assert [(x.tolist(), p, q) for x, p, q in alone] == [(x.tolist(), p, q) for x, p, q in got[i]]


def test_decoding_equals_library():
    """Decoding by the table of pieces gives the library's text, whatever the ids; it is asked only where the table can't tell."""
    import sentencepiece
    from recordlink.llm.op7_sampling import make_decoder
    sp, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(5)
    n, calls = sp.get_piece_size(), []
    back = make_decoder(MODEL)[0]
    blanks = [i for i in range(n) if sp.id_to_piece(i).strip("▁") == ""]
    lists = [[rng.randrange(n) for _ in range(rng.randrange(1, 9))] for _ in range(300)]
    lists += [[rng.randrange(260) for _ in range(5)] for _ in range(100)]           # control pieces, bytes of no character
    lists += [[a, b, 500] for a in blanks for b in blanks] + [[i] for i in range(300)]
    lists += [sp.encode(x) for x in ("é☃🙂 a\0b\n\n c  d", " x", "\n", "▁▁x ▁")]
    for ids in lists:
        assert back(ids) == back(np.array(ids)) == sp.decode(ids)
    assert back(None) is None and back([]) == ""
    with pytest.raises(IndexError):
        back([n])
    plain = sp.encode("the cat sat on the mat " * 50)
    sys.setprofile(lambda frame, event, _: event == "call" and frame.f_code.co_name == "_decode_raw" and calls.append(1))
    try:
        back(np.array(plain))
    finally:
        sys.setprofile(None)
    assert not calls


def test_a_worker_makes_its_sampler_once():
    from recordlink.llm import op7_sampling
    one = op7_sampling.worker_sampler(MODEL, 2, 0, 1.0)
    assert op7_sampling.worker_sampler(MODEL, 2, 0, 1.0) is one
    assert op7_sampling.worker_sampler(MODEL, 3, 0, 1.0) is not one


def test_all_segmentations_when_few():
    found = make_sampler(MODEL, 50, 1)(["a"], [3])[0]
    want = _all_segmentations("a")
    assert {tuple(f[0].tolist()) for f in found} == set(want) and all(f[2] == 0.0 for f in found)


def test_round_trip_and_partition_independence(spark):
    docs = edge_documents(spark).select("doc_id", "text", "ids", "kind")
    docs = docs.filter("doc_id is null or doc_id <> 5").unionByName(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.lit(1).alias("ids"), F.lit("k").alias("kind")))
    out = sample_encodings(docs, k=3)
    rows = decode(out.select("doc_id", "sample", F.col("ids").alias("pieces"), "log_prob"), "pieces").collect()
    texts = Counter((d.doc_id, d.text or "") for d in docs.collect())
    first = Counter((r.doc_id, r.text) for r in rows if r["sample"] == 1)
    assert first == texts
    assert all(first[r.doc_id, r.text] for r in rows)
    again = sample_encodings(docs.repartition(7), k=3)
    key = lambda d: Counter((r.doc_id, r["sample"], r.n_pieces, r.ids_crc32, r.log_prob, r.log_inclusion) for r in d.collect())
    assert key(out) == key(again)
    assert sample_encodings(empty_documents(spark)).count() == 0


def test_digest_comes_from_the_decoded_text(spark):
    import zlib
    docs = edge_documents(spark).select("doc_id", "text").unionByName(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text"))
    rows = sample_encodings(docs, k=2, with_ids=False).collect()
    assert all(r.round_trip for r in rows)
    want = Counter((d.doc_id, zlib.crc32((d.text or "").encode())) for d in docs.collect())
    assert Counter((r.doc_id, r.text_crc32) for r in rows if r["sample"] == 1) == want


# --- Jaccard join ------------------------------------------------------------------------------

def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if w and len(w) < k else [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])


def brute_components(rows, k, percent):
    """rows: (id, text) -> list of (id, n, component id), by comparing all pairs of distinct sets."""
    sets = [shingles(t, k) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=lambda s: (len(s), sorted(s)))
    parent = list(range(len(distinct)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(distinct):
        for j in range(i + 1, len(distinct)):
            b = distinct[j]
            if 100 * len(a) < percent * len(b):
                break
            n = len(a & b)
            if 100 * n >= percent * (len(a) + len(b) - n):
                parent[root(i)] = root(j)
    at = {s: i for i, s in enumerate(distinct)}
    low = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            low[root(at[s])] = min(i, low.get(root(at[s]), i))
    return [(i, len(s), low.get(root(at[s])) if s else i) for (i, _), s in zip(rows, sets)]


def family(rng, base, copies, edits):
    words = base.split()
    for _ in range(copies):
        w = list(words)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        yield " ".join(w)


@pytest.mark.parametrize("k,percent,settings", [(3, 90, {}), (5, 80, {}), (3, 90, dict(group_rows=4, hot_groups=2)), (3, 50, dict(group_rows=3, hot_groups=1)),
                                                (2, 100, {}), (3, 90, dict(hot_groups=1, hot_tokens=5))])
def test_components_equal_brute_force(spark, k, percent, settings):
    rng = random.Random(k * percent)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(30))
    rows = []
    for size in (8, 12, 40, 120):
        base = " ".join(rng.choice(vocabulary) for _ in range(size))
        rows += list(family(rng, base, 25, max(1, size // 12)))
    rows += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))) for _ in range(40)]
    rows += [passage] * 10 + [None, "", " \n", "a", "A", "a b", "A  B", "a b c", "É", "é"]
    rows += [" ".join(["z"] * n) for n in (1, 2, 3, 4, 50)]
    rng.shuffle(rows)
    data = [(i * 3 % 997, t) for i, t in enumerate(rows)] + [(None, rows[0]), (None, "only null id here"), (5, rows[1]), (5, rows[2])]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'q' as token", "1 as gid", "2 as n", "3 as lead")
    got = Counter(tuple(r) for r in jaccard_components(docs, k, percent, **settings).collect())
    assert got == Counter(brute_components(data, k, percent))


def test_components_empty_and_edge(spark):
    assert jaccard_components(empty_documents(spark)).count() == 0
    assert one_per_component(empty_documents(spark)).count() == 0
    docs = edge_documents(spark)
    data = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(tuple(r) for r in jaccard_components(docs).collect()) == Counter(brute_components(data, 3, 90))


def test_long_chain_settles(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(f"{a:05d}".encode(), f"{b:05d}".encode()) for a, b in zip(order, order[1:])] + [(b"y", b"z"), (b"z", b"z")],
                                  "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in components(edges).collect()}
    assert got == {f"{i:05d}".encode(): b"00000" for i in range(n)} | {b"y": b"y", b"z": b"y"}


def plans_kept(monkeypatch):
    """A list that gets (name, exchanges in the plan, rows) of each table that op8 writes from now on."""
    seen, keep = [], op8.keep

    def watched(df, name):
        kept = keep(df, name)
        seen.append((name, df._jdf.queryExecution().executedPlan().toString().count("Exchange"), kept.count()))
        return kept

    monkeypatch.setattr(op8, "keep", watched)
    return seen


def test_rounds_of_components_have_small_plans(spark, monkeypatch):
    """The driver keeps the plans of all rounds: one star to a plan."""
    seen = plans_kept(monkeypatch)
    edges = spark.createDataFrame([(f"{i}".encode(), f"{i + 1}".encode()) for i in range(10)], "a binary, b binary")
    assert components(edges).count() == 11
    assert max(n for _, n, _ in seen) < 20


def test_only_sets_short_of_cold_tokens_are_read_again(spark, monkeypatch):
    seen, rng = plans_kept(monkeypatch), random.Random(8)
    passage = " ".join(f"p{i}" for i in range(30))
    plain = [" ".join(f"d{i}w{rng.randrange(10 ** 6)}" for _ in range(40)) for i in range(60)]
    shared = [f"{passage} e{i} f{i} g{i}" for i in range(12)]
    data = list(enumerate(plain + shared + shared))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_components(docs, 3, 90, group_rows=2, hot_groups=1).collect())
    assert got == Counter(brute_components(data, 3, 90))
    rows = {name: n for name, _, n in seen}
    assert 0 < rows["late-wanted"] <= 12 and rows["late"] == rows["late-wanted"]


def test_only_sets_that_hold_shared_tokens_are_asked(spark):
    """Units that meet by one token pass on the set that holds it, not all their sets."""
    sets = [(b"a", 1, [-5, 2, 3]), (b"b", 1, [7, 8, 9]), (b"c", 1, [2, 8, 40]), (b"d", 2, [2, 50])]
    full = spark.createDataFrame([(k, g, np.array(t, ">i8").tobytes()) for k, g, t in sets], "set_key binary, gid long, tokens binary")
    for need, tokens, want in ((1, [2], b"ac"), (2, [2, 8], b"c"), (1, [-5], b"a"), (1, [99], b""), (1, None, b"abc")):
        asks = (spark.createDataFrame([(1, 2, need, tokens, 0)], "g1 long, g2 long, need long, tokens array<long>, block int")
                .withColumn("tokens", F.transform("tokens", op8._as_stored)))
        got = [(r.to_gid, r.to_block, bytes(r.q_set_key)) for r in op8._queries(full, asks).collect()]
        assert sorted(got) == [(2, 0, bytes([k])) for k in want]


def test_pairs_name_the_tokens_that_choose_their_sets(spark, monkeypatch):
    """Families whose texts share a line with some texts of the others: the links are those of all pairs,
    and the written pairs name the tokens by which sets are chosen."""
    seen, rng = [], random.Random(11)
    keep = op8.keep
    monkeypatch.setattr(op8, "keep", lambda df, name: (seen.append((name, kept := keep(df, name), kept.collect() if name == "pairs" else None)), kept)[1])
    data = []
    for f in range(6):
        base = [f"f{f}w{i}" for i in range(60)]
        for i in range(20):
            w = list(base)
            w[rng.randrange(60)] = f"x{f}y{i}"
            data.append((len(data), " ".join(w + [f"common{(f + i) % 7} passage{i % 3} here"] * 2)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard_components(docs, 3, 60, group_rows=8, hot_groups=1).collect())
    assert got == Counter(brute_components(data, 3, 60))
    rows = [r for name, _, found in seen if name == "pairs" for r in found]
    assert rows and all(r.need >= 1 and (r.tokens is None or len(r.tokens) >= r.need) for r in rows)


def test_shuffle_files_go_when_a_table_is_written(spark):
    """Not only when the driver collects its garbage."""
    import time
    from recordlink.llm.common import discard, keep
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {x for x in (disk.getAllFiles().mkString("\n")).split("\n") if "shuffle_" in x}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held, before = spark.conf.get(name, None), files()
    kept = keep(spark.range(20_000).groupBy((F.col("id") % 999).alias("k")).count(), "freed")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and kept.count() == 999
    assert spark.conf.get(name, None) == held
    discard(kept)


def test_one_per_component(spark):
    docs = edge_documents(spark)
    kept = one_per_component(docs, 5, 80)
    assert kept.columns == docs.columns
    data = [(r.doc_id, r.text) for r in docs.collect()]
    comps = brute_components(data, 5, 80)
    full = {c for _, n, c in comps if n}
    out = kept.collect()
    assert sorted(r.doc_id for r in out if shingles(r.text, 5)) == sorted(full)
    assert sum(not shingles(r.text, 5) for r in out) == sum(n == 0 for _, n, _ in comps)


# --- pipeline ----------------------------------------------------------------------------------

def _brute_pipeline(spark, docs):
    """Texts that reach packing, by document id."""
    keep = {r.doc_id for r in quality_report(docs).filter("kept").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in keep]
    stay = {c for _, _, c in brute_components(rows, 5, 80)}
    scan, out = secret_scanner(), {}
    for i, text in rows:
        if i in stay:
            found, done, parts = scan(text), 0, []
            for _, s, e, _ in found:
                if s >= done:
                    parts += [text[done:s], "[secret]"]
                done = max(done, e)
            out[i] = "".join([*parts, text[done:]])
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    from tokenizers import Tokenizer
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame([(10_001, None), (10_002, ""), (10_003, "short text")], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    t = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    want = {i: t.encode(x, add_special_tokens=False).ids + [2] for i, x in _brute_pipeline(spark, docs).items()}
    cur = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, cur, str(tmp_path)).checkpoint()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        cur = out
    got = defaultdict(dict)
    for r in cur.collect():
        got[r.doc_id][r.start] = np.frombuffer(r.ids, "<u2").tolist()
    assert {i: [x for s in sorted(p) for x in p[s]] for i, p in got.items()} == want
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == Counter(want.keys())


def test_stages_take_empty_documents(spark):
    cur = empty_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        cur = stage(spark, cur, "/nowhere")
        assert cur.count() == 0


def test_outlying_copies_and_null_ids(spark):
    """A family whose copies link to its middle only, outliers that link to nothing, and rows without ids."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = [" ".join(base)]
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(0, 60, 12), 1 + i % 3):
            w[at + rng.randrange(4)] = f"x{rng.randrange(10 ** 6)}"
        rows.append(" ".join(w))
    rows += [" ".join(base[:40]) + " " + " ".join(f"o{i}w{j}" for j in range(20 + i % 9)) for i in range(60)]
    data = [(i if i % 3 else None, t) for i, t in enumerate(rows)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    for settings in ({}, dict(group_rows=8, hot_groups=2)):
        assert Counter(tuple(r) for r in jaccard_components(docs, 3, 80, **settings).collect()) == Counter(brute_components(data, 3, 80))
