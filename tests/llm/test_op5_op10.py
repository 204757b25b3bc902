import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from recordlink.llm.op5_warc import read_chunks, read_records, write_warc
from recordlink.llm.op10_sharding import assign_shards, write_shards
from tests.llm.edge import edge_documents, empty_documents

SF = "/root/testdata/sf0.01"


def _pages(spark):
    long = "<p>" + "0123456789abcdef" * 20_000
    same = "x" * 120
    rows = [(1, "http://a/", "<html>a"), (2, None, None), (3, "http://b/\r\nEvil: 1", ""), (9, "u", same), (4, "u", same),
            (5, "u", same), (6, "u", "y" * 99), (7, "u", "y" * 99), (8, "é", long + "é"), (10, "v", long + "é"),
            (11, "v", "é" * 50), (12, "v", "é" * 50), (12, "v", "é" * 50), (None, "w", same), (13, "z", "\r\n\r\nWARC/1.1\r\n\r\n")]
    rows += [(100 + i, "hot", "h" * 200) for i in range(50)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_warc_round_trip(spark):
    pages = _pages(spark).repartition(4).checkpoint()
    first = {}
    data = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    for i, p in data:
        if i is not None and len(p) >= 100:
            first[p] = min(i, first.get(p, i))
    want = Counter()
    for i, p in data:
        to = first.get(p)
        revisit = to is not None and (i is None or i > to)       # null is not the smallest id
        want[i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", to if revisit else None] += 1
    manifest = write_warc(pages)
    got = Counter(tuple(r) for r in read_records(manifest).collect())
    assert got == want
    chunks = read_chunks(manifest, chunk=1000).collect()
    by = defaultdict(list)
    for c in chunks:
        assert c.content is None or len(c.content) <= 1000
        by[c.record_id].append(c)
    texts = Counter()
    for cs in by.values():
        cs.sort(key=lambda c: c.chunk_no)
        assert [c.chunk_no for c in cs] == list(range(len(cs))) and [c.is_last for c in cs] == [False] * (len(cs) - 1) + [True]
        if cs[0].record_type == "response":
            sha = hashlib.sha256()
            for c in cs:                        # the running digest covers all chunks so far
                sha.update(c.content)
                assert sha.hexdigest() == c.payload_digest
            texts[cs[0].page_id, b"".join(c.content for c in cs)] += 1
    assert texts == Counter((i, p) for i, p in data if not (first.get(p) is not None and (i is None or i > first[p])))


def test_plan_is_the_same_joined_or_broadcast(spark):
    from recordlink.llm.op5_warc import plan_records
    a, b = (Counter((r.page_id, r.digest, r.refers_to) for r in plan_records(_pages(spark), broadcast_rows=n).collect()) for n in (0, 1000))
    assert a == b and sum(a.values()) == _pages(spark).count()


def test_warc_is_readable_gzip(spark):
    import gzip
    m = write_warc(_pages(spark).coalesce(1)).first()
    raw = gzip.decompress(open(m.path.replace("file://", "").replace("file:", ""), "rb").read())
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")


def test_warc_damage_is_seen(spark):
    m = write_warc(_pages(spark).coalesce(1))
    path = m.first().path.replace("file://", "").replace("file:", "")
    data = bytearray(open(path, "rb").read())
    open(path, "wb").write(bytes(data[:len(data) // 2]))
    with pytest.raises(Exception):
        read_records(m).count()


def test_warc_empty(spark):
    assert read_records(write_warc(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def _check_shards(docs, out, shards):
    rows = out.collect()
    data = docs.collect()
    want = Counter((d.doc_id, len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode()), d.source) for d in data)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.source) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    total = Counter(d.source for d in data)
    mix = Counter((r.source, r.shard) for r in rows)
    for s, n in total.items():       # every shard holds each source in proportion
        for k in range(shards):
            assert abs(mix[s, k] - n * sizes[k] / len(rows)) <= 2 + len(total) / 4, (s, k)
    return {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in rows}


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards(spark, shards):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = _check_shards(docs, assign_shards(docs, shards), shards)
    assert a == _check_shards(docs, assign_shards(docs.repartition(5), shards), shards)     # input layout does not matter


def test_seed_matters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = ({r.doc_id: r.shard for r in assign_shards(docs, 8, seed).collect()} for seed in (1, 2))
    assert a != b


def test_shards_edge(spark):
    docs = edge_documents(spark)
    _check_shards(docs, assign_shards(docs, 4), 4)
    _check_shards(docs, assign_shards(docs, 40), 40)
    assert assign_shards(empty_documents(spark)).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    write_shards(docs, str(tmp_path / "s"), 5)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r.text for r in back.select("text").collect()) == sorted(r.text for r in docs.select("text").collect())


def test_written_shards_hold_every_row(spark, tmp_path):
    twins = spark.createDataFrame([(6, "same", "en", "a", 4), (6, "same", "de", "b", 4), (6, "same", "de", None, 5),
                                   (None, "same", "en", "a", 4), (None, "same", "en", "a", 4)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    docs = edge_documents(spark).unionByName(twins, allowMissingColumns=True).withColumn("_row", F.lit(7))
    write_shards(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(back.columns) == sorted([*docs.columns, "shard", "slot"])
    rows = back.collect()
    assert Counter(tuple(r[c] for c in docs.columns) for r in rows) == Counter(map(tuple, docs.collect()))

    def place(rows, size, crc):
        return Counter((r.doc_id, r.source, size(r), crc(r), r.shard, r.slot) for r in rows)

    plan = assign_shards(docs, 4).collect()      # rows with equal keys may swap their slots, others not
    assert place(rows, lambda r: len((r.text or "").encode()) + 16, lambda r: zlib.crc32((r.text or "").encode())) \
        == place(plan, lambda r: r.size, lambda r: r.text_crc32)
