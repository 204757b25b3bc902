"""Token-ID output: length-delimited binary records with masked checksums and an offset index.

File format, one pair of files per range of document ids:

* ``part-NNNNN-*.rec``: records ``u64 length, u32 masked crc32c(length), payload,
  u32 masked crc32c(payload)``, little-endian; mask ``rotate right 15, plus 0xa282ead8``.
  Payload: ``u8 has_id, i64 doc_id, ids`` as 16-bit unsigned integers.
* ``part-NNNNN-*.idx``: per record ``u64 byte offset, u64 ids before it in the file``, for
  reads in any order.

Rows are sorted by document id across files (range partitioning; repeated and null ids are
spread by the text's hash, nulls first). A task writes files under a name of its own attempt
and returns their names as its row; the list of files is a Spark table, so after a lost executor
or a speculative copy exactly one attempt's files are listed.

Edge cases: a null text is empty and still holds the end id; a null id is kept (flag byte);
repeated rows are separate records; an empty table gives no file and no row; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import keep, open_fs, running_offsets, shared_path, tasks_of
from recordlink.llm.encoding import crc_of, ids_of, text_encoder, vocabulary_path

MANIFEST = "part int, path string, n_records long, n_tokens long, n_bytes long"
READ = "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long, ids binary"


def crc32c_many(blobs: list[bytes]) -> list[int]:
    """CRC-32C of each blob, vectorised over 512-byte blocks of all blobs together.

    A CRC is linear: a blob with its first four bytes inverted, padded in front with zeros to
    whole blocks, has the register of the blob from the all-ones start. Blobs of eight bytes
    need no block. Blocks run side by
    side from a zero register and are chained with the table that advances a register by one
    block.
    """
    import sys
    import types

    import numpy as np
    store = sys.modules.setdefault("_llm_worker_store", types.ModuleType("_llm_worker_store"))
    size = 512
    if "crc32c" not in store.__dict__:
        poly, t = 0x82F63B78, np.arange(256, dtype=np.uint32)     # the Castagnoli polynomial, reflected
        for _ in range(8):
            t = np.where(t & 1, (t >> 1) ^ np.uint32(poly), t >> 1).astype(np.uint32)
        tabs = [t]
        for _ in range(3):
            tabs.append(t[tabs[-1] & 0xFF] ^ (tabs[-1] >> 8))
        skip = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        for _ in range(size):
            skip = [t[s & 0xFF] ^ (s >> 8) for s in skip]
        store.__dict__["crc32c"] = (tabs, [s.tolist() for s in skip])
    tabs, skip = store.__dict__["crc32c"]

    def on(c):
        """Registers four bytes on, which are already in them."""
        return tabs[3][c & 0xFF] ^ tabs[2][(c >> 8) & 0xFF] ^ tabs[1][(c >> 16) & 0xFF] ^ tabs[0][c >> 24]

    out, longer, eight = [0] * len(blobs), [], []
    for i, b in enumerate(blobs):
        if len(b) == 8:                 # record heads: two steps, not a block each
            eight.append(i)
        elif len(b) < 4:
            c = 0xFFFFFFFF
            for x in b:
                c = int(tabs[0][(c ^ x) & 0xFF]) ^ (c >> 8)
            out[i] = c ^ 0xFFFFFFFF
        else:
            longer.append(i)
    if eight:
        w = np.frombuffer(b"".join([blobs[i] for i in eight]), "<u4").reshape(-1, 2)
        for i, c in zip(eight, (on(on(w[:, 0] ^ np.uint32(0xFFFFFFFF)) ^ w[:, 1]) ^ np.uint32(0xFFFFFFFF)).tolist()):
            out[i] = c
    if not longer:
        return out
    blocks = [-(-len(blobs[i]) // size) for i in longer]
    buf = bytearray(sum(blocks) * size)
    at = 0
    for i, n in zip(longer, blocks):
        b = blobs[i]
        s = at + n * size - len(b)
        buf[s:at + n * size] = b
        for k in range(4):
            buf[s + k] ^= 0xFF
        at += n * size
    words = np.ascontiguousarray(np.frombuffer(buf, "<u4").reshape(-1, size // 4).T)
    c = np.zeros(words.shape[1], np.uint32)
    for w in words:
        c ^= w
        c = on(c)
    c, at = c.tolist(), 0
    for i, n in zip(longer, blocks):
        r = c[at]
        for x in c[at + 1:at + n]:
            r = skip[0][r & 0xFF] ^ skip[1][(r >> 8) & 0xFF] ^ skip[2][(r >> 16) & 0xFF] ^ skip[3][r >> 24] ^ x
        out[i] = r ^ 0xFFFFFFFF
        at += n
    return out


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def write_records(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                  end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text",
                  files: int | None = None) -> DataFrame:
    """Encode, sort by id and write the record files; returns the table of written files."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "records")
    tokenizer = tokenizer or vocabulary_path("byte_bpe_50k.json")
    end = b"" if end_id is None else int(end_id).to_bytes(2, "little")

    def run(batches):
        import struct
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext
        part, name, n_rec, n_tok, n_byte = TaskContext.get().partitionId(), None, 0, 0, 0
        out = index = None
        encode = text_encoder(tokenizer)
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                piece = b.slice(i, 4096)
                docs_, ids = piece.column(0).to_pylist(), [x + end for x in encode(piece.column(1))]
                loads = [struct.pack("<Bq", d is not None, d or 0) + x for d, x in zip(docs_, ids)]
                heads = [struct.pack("<Q", len(x)) for x in loads]
                sums = crc32c_many(heads + loads)
                lines, places = [], []
                for k, (h, x) in enumerate(zip(heads, loads)):
                    places.append(struct.pack("<QQ", n_byte, n_tok))
                    lines += [h, struct.pack("<I", masked(sums[k])), x,
                              struct.pack("<I", masked(sums[len(heads) + k]))]
                    n_byte += len(x) + 16
                    n_tok += len(ids[k]) // 2
                    n_rec += 1
                if out is None:
                    fs, base = open_fs(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"part-{part:05d}-{uuid.uuid4().hex[:12]}"
                    out, index = fs.open_output_stream(f"{base}/{name}.rec"), fs.open_output_stream(f"{base}/{name}.idx")
                out.write(b"".join(lines))
                index.write(b"".join(places))
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"],
                                              "n_records": [n_rec], "n_tokens": [n_tok], "n_bytes": [n_byte]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spread = F.xxhash64("text")
    placed = (rows.repartitionByRange(files or tasks_of(spark), F.col("doc_id").asc_nulls_first(), spread)
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), spread))
    return keep(placed.mapInArrow(run, MANIFEST), "manifest")


def read_records(manifest: DataFrame, block: int = 4096, with_ids: bool = True) -> DataFrame:
    """Read the files back, checking every length and checksum: one row per record, with the
    number of ids before it in all files. Blocks of ``block`` records are found through the
    index and read by different tasks, so a large file is shared out."""
    spark = manifest.sparkSession
    parts = manifest.select("part", "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_records") - 1,
                                                                 F.lit(block).cast("long"))).alias("first"),
                            "n_records", "n_bytes")

    def run(batches):
        import struct

        import numpy as np
        import pyarrow as pa
        for b in batches:
            for r in b.to_pylist():
                fs, base = open_fs(r["path"])
                n = min(block, r["n_records"] - r["first"])
                with fs.open_input_file(base + ".idx") as f:
                    f.seek(16 * r["first"])
                    places = np.frombuffer(f.read(16 * (n + 1)), "<u8").reshape(-1, 2)
                ends = places[1:n + 1, 0].tolist()
                if len(ends) < n:
                    ends.append(r["n_bytes"])
                with fs.open_input_file(base + ".rec") as f:
                    f.seek(int(places[0, 0]))
                    for i in range(0, n, 256):
                        k = min(256, n - i)
                        data = f.read(ends[i + k - 1] - int(places[i, 0]))
                        heads, loads, want, at = [], [], [], 0
                        for _ in range(k):
                            heads.append(data[at:at + 8])
                            size = struct.unpack("<Q", heads[-1])[0]
                            loads.append(data[at + 12:at + 12 + size])
                            want.append((data[at + 8:at + 12], data[at + 12 + size:at + 16 + size]))
                            at += 16 + size
                        sums = crc32c_many(heads + loads)
                        for j, (h, x) in enumerate(want):
                            if h != struct.pack("<I", masked(sums[j])) or x != struct.pack("<I", masked(sums[k + j])):
                                raise ValueError(f"checksum differs: {r['path']} record {r['first'] + i + j}")
                        if at != len(data):
                            raise ValueError(f"length differs: {r['path']} record {r['first'] + i}")
                        ids = [x[9:] for x in loads]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([struct.unpack("<q", x[1:9])[0] if x[0] else None for x in loads], pa.int64()),
                             pa.array([r["part"]] * k, pa.int32()), pa.array(places[i:i + k, 1].astype("i8")),
                             pa.array([len(x) // 2 for x in ids], pa.int64()),
                             pa.array([crc_of(ids_of(x)) for x in ids], pa.int64()),
                             pa.array(ids if with_ids else [None] * k, pa.binary())],
                            names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32", "ids"])

    rows = parts.repartition(2 * tasks_of(spark)).mapInArrow(run, READ)
    # One row per file: bounded by the number of files, not by the number of records.
    offsets = F.broadcast(running_offsets(manifest.select("part", "n_tokens"), "part", "n_tokens", "before"))
    out = rows.join(offsets, "part").select("doc_id", (F.col("before") + F.col("local_start")).alias("start"),
                                            "n_tokens", "ids_crc32", "ids")
    return out if with_ids else out.drop("ids")
