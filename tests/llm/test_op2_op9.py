import functools
import struct
import tracemalloc
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from recordlink.llm.encoding import text_encoder, vocabulary_path
from recordlink.llm.op2_packing import assemble, pack
from recordlink.llm.op9_binary import crc32c_many, masked, read_records, write_records
from tests.llm.edge import edge_documents, empty_documents

SF = "/root/testdata/sf0.001"


@functools.cache
def _library(name):
    t = Tokenizer.from_file(vocabulary_path(name))
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


TRICKY = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a\n\n\nb \t", "it's we'll don'T I'M",
          "É àÿ ÷ × µª º", "x\x1fy\x1c z", "12 345 6½²", " nbsp\u0085nel x", "Σας ΑΣ", "東京 tower",
          "<|endoftext|> <|startoftext|>", "a|b||c!!! ...", "\r\n\r\n x", "İstanbul ǅ", "é"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(spark, name):
    texts = TRICKY + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["".join(p) for p in zip(TRICKY, reversed(TRICKY))]
    for cache in (1_000_000, 7):
        got = [np.frombuffer(b, "<u2").tolist() for b in text_encoder(vocabulary_path(name), cache)(texts)]
        assert got == [_library(name)(t) for t in texts]


def _check_pieces(docs, pieces, length, end):
    ids = _library("word_bpe_49k.json")
    want = sorted((r.doc_id if r.doc_id is not None else -1, tuple(ids(r.text) + end)) for r in docs.collect())
    rows = pieces.collect()
    by_seq, by_doc = {}, {}
    for r in rows:
        part = np.frombuffer(r.ids, "<u2").tolist()
        assert len(part) == r.length and _crc(part) == r.ids_crc32
        by_seq.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.sequence_id * length + r.offset - r.start), []).append(r)
    for seq, rs in by_seq.items():      # gapless from 0, full unless last
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == length or seq == max(by_seq)
    got = []
    for rs in by_doc.values():          # one entry per document: its global start
        rs.sort(key=lambda r: r.start)
        flat = [x for r in rs for x in np.frombuffer(r.ids, "<u2").tolist()]
        assert {r.doc_tokens for r in rs} == {len(flat)}
        got.append((rs[0].doc_id if rs[0].doc_id is not None else -1, tuple(flat)))
    assert sorted(got) == want
    return by_seq


@pytest.mark.parametrize("length", [16, 4096])
def test_pack_edge(spark, length):
    docs = edge_documents(spark).repartition(3)
    docs = docs.checkpoint()
    _check_pieces(docs, pack(docs, length=length), length, [2])


def test_pack_table_and_sequences(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5).checkpoint()
    pieces = pack(docs, length=512).checkpoint()
    by_seq = _check_pieces(docs, pieces, 512, [2])
    seqs = assemble(pieces, pad_id=0, length=512).collect()
    assert sorted(r.sequence_id for r in seqs) == sorted(by_seq)
    for r in seqs:
        n = r.n_ids
        assert len(r.ids) == (n if n & (n - 1) == 0 else 512)


def test_pack_empty(spark):
    assert pack(empty_documents(spark)).count() == 0


def test_crc32c_of_record_heads_takes_no_blocks():
    heads = [i.to_bytes(8, "little") for i in range(20_000)]
    crc32c_many(heads[:1])
    tracemalloc.start()
    try:
        got = crc32c_many(heads)
        assert tracemalloc.get_traced_memory()[1] < 512 * len(heads) // 2
    finally:
        tracemalloc.stop()
    mixed = crc32c_many([x for h in heads[:50] for x in (h, h + b"x")])
    assert mixed[::2] == got[:50] and got[0] == 0x8C28B28A


def test_crc32c_known_values():
    # published check values of CRC-32C
    assert crc32c_many([b"123456789"]) == [0xE3069283]
    assert crc32c_many([b"", b"a", bytes(32), b"\xff" * 32]) == [0, 0xC1D04330, 0x8A9136AA, 0x62A8AB43]
    rng = np.random.default_rng(1)
    blobs = [rng.bytes(n) for n in (3, 4, 5, 511, 512, 513, 5000)]
    assert crc32c_many(blobs) == [crc32c_many([b])[0] for b in blobs]

    def plain(b):
        c = 0xFFFFFFFF
        for x in b:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF
    assert crc32c_many(blobs) == [plain(b) for b in blobs]


def test_records_round_trip(spark):
    ids = _library("byte_bpe_50k.json")
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = table.select("doc_id", "text").unionByName(edge_documents(spark).select("doc_id", "text"))
    manifest = write_records(docs, files=5)
    rows = sorted(read_records(manifest, block=7).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda x: (x is not None, x or 0))
    at = 0
    for r in rows:
        flat = np.frombuffer(r.ids, "<u2").tolist()
        assert r.start == at and r.n_tokens == len(flat) and _crc(flat) == r.ids_crc32
        at += r.n_tokens
    want = sorted((r.doc_id if r.doc_id is not None else -1, ids(r.text) + [0]) for r in docs.collect())
    assert sorted((r.doc_id if r.doc_id is not None else -1, np.frombuffer(r.ids, "<u2").tolist()) for r in rows) == want


def test_record_format_and_damage(spark):
    docs = spark.createDataFrame([(7, "hello world"), (9, None)], "doc_id long, text string")
    manifest = write_records(docs, files=1)
    path = manifest.first().path.replace("file://", "")
    path = path[5:] if path.startswith("file:") else path
    data = open(path + ".rec", "rb").read()
    size = struct.unpack("<Q", data[:8])[0]
    assert struct.unpack("<I", data[8:12])[0] == masked(crc32c_many([data[:8]])[0])
    assert struct.unpack("<I", data[12 + size:16 + size])[0] == masked(crc32c_many([data[12:12 + size]])[0])
    assert len(open(path + ".idx", "rb").read()) == 32
    with open(path + ".rec", "r+b") as f:
        f.seek(25)
        f.write(b"\xee")
    with pytest.raises(Exception, match="checksum"):
        read_records(manifest).count()


def test_records_empty(spark):
    assert read_records(write_records(empty_documents(spark))).count() == 0


def test_worker_memory_stays_bounded():
    """Python workers live through all stages: what they hold of words, and take for a block of texts, is bounded."""
    import os
    import subprocess
    import sys
    code = """
import pyarrow as pa
from recordlink.llm.encoding import text_encoder, vocabulary_path
from recordlink.llm.op8_jaccard import _shingler
import numpy as np
words = [f"w{i}x" for i in range(40_000)]
text = " ".join(words[:4000])
encode = text_encoder(vocabulary_path("word_bpe_49k.json"))
texts = pa.array([text] * 800)                  # 20 MB
before = pa.total_allocated_bytes()
ids = encode(texts)
assert len(set(ids)) == 1 and ids[0] == encode([text])[0]
print(len(text) * 800, pa.default_memory_pool().max_memory() - before)
with np.errstate(over="ignore"):
    shingles = _shingler(3)
    for i in range(10):
        shingles(" ".join(f"{w}{i}" for w in words))
import _llm_worker_store
print(len(_llm_worker_store.word_hashes))
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    size, arrow, held = map(int, out)
    assert size > 18_000_000 and arrow < 50_000_000 and held <= 150_000


def test_worker_holds_the_words_of_one_operator():
    """A worker that packs, then joins, does not keep the encoder while it joins."""
    import gc
    import sys
    import weakref

    from recordlink.llm.op8_jaccard import _shingler
    encode = text_encoder(vocabulary_path("word_bpe_49k.json"))
    assert len(encode(["some words"])[0])
    held = weakref.ref(encode)
    del encode
    with np.errstate(over="ignore"):
        assert len(_shingler(3)("a b c d")) == 2
    gc.collect()
    assert held() is None
    assert sys.modules["_llm_worker_store"].word_hashes
    text_encoder(vocabulary_path("word_bpe_49k.json"))
    assert "word_hashes" not in vars(sys.modules["_llm_worker_store"])


def test_texts_are_handled_in_small_batches(spark, monkeypatch):
    """However large an Arrow batch is, packing and redacting put out few rows at once, all of them."""
    import pyarrow as pa
    import pyspark
    from recordlink.llm import op2_packing, op6_secrets

    class Docs:
        """Hands the function given to ``mapInArrow`` to the test."""
        columns, schema = ["doc_id", "text"], spark.createDataFrame([], "doc_id long, text string").schema

        def select(self, *cols):
            return self

        def mapInArrow(self, run, schema):
            return run

    class Task:
        @staticmethod
        def get():
            return type("T", (), {"partitionId": lambda self: 3})()

    monkeypatch.setattr(pyspark, "TaskContext", Task)
    n = 5000
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([f"password = 'abcdefgh{i}'" for i in range(n)])],
                                       names=["doc_id", "text"])
    packed = list(op2_packing.encode_partitions(Docs(), vocabulary_path("word_bpe_49k.json"), 2)([batch]))
    assert max(b.num_rows for b in packed) <= 2048 and [x for b in packed for x in b.column(0).to_pylist()] == list(range(n))
    sizes, starts = ([x for b in packed for x in b.column(c).to_pylist()] for c in (3, 2))
    assert starts == [0, *np.cumsum(sizes)[:-1].tolist()]
    clean = list(op6_secrets.redact(Docs())([batch]))
    assert max(b.num_rows for b in clean) <= 512 and [x for b in clean for x in b.column(0).to_pylist()] == list(range(n))
    assert not any("abcdefgh" in t for b in clean for t in b.column(1).to_pylist())


def test_kept_rows_come_in_batches_of_the_size_asked_for(spark):
    from recordlink.llm.common import keep
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def run(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    rows, before = spark.range(0, 1000, 1, 1).mapInArrow(run, "n long"), spark.conf.get(size)
    assert sorted(r.n for r in keep(rows, "few", 300).collect()) == [100, 300, 300, 300]
    assert spark.conf.get(size) == before
    assert sum(r.n for r in keep(rows, "all").collect()) == 1000
