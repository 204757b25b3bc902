"""Packing: concatenate and cut, with two-pass prefix sums.

Pass one encodes each text and writes its ids with their start inside the task's partition.
The partitions' token totals then give each partition's global offset (one number per
partition), and pass two turns partition starts into global starts and cuts every document at
the multiples of ``length``. A document that crosses a cut leaves boundary records: one piece
in each sequence it touches. No text or id is shuffled; both passes are narrow.

Edge cases: a null text is empty and still holds its end id; a null id is kept as null;
repeated rows are separate documents; an empty table gives no piece; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import give_back, keep, running_offsets, worker_held
from recordlink.llm.encoding import crc_of, ids_of, text_encoder, vocabulary_path

ENCODED = "doc_id long, part int, local_start long, n_tokens long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
BATCH_ROWS = 2048       # rows of texts or ids that are handled at once


def encode_partitions(docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str = "doc_id",
                      text_col: str = "text", cache_words: int = 600_000) -> DataFrame:
    """One row per document: its ids (16-bit, end id included) and, inside the partition that
    made it, the number of ids before it."""
    end = b"" if end_id is None else int(end_id).to_bytes(2, "little")

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        encode, part, at = text_encoder(tokenizer, cache_words, 1 << 20), TaskContext.get().partitionId(), 0
        for b in batches:
            for i in range(0, b.num_rows, BATCH_ROWS):
                piece = b.slice(i, BATCH_ROWS)
                ids = [x + end for x in encode(piece.column(1))]
                sizes, starts = [len(x) // 2 for x in ids], []
                for n in sizes:
                    starts.append(at)
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([part] * len(ids), pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(ids, pa.binary())],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"])
        give_back()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, ENCODED))


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = 4096, end_id: int | None = 2,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
         cache_words: int = 600_000) -> DataFrame:
    """Pieces of all documents, concatenated in partition order and cut every ``length`` ids.

    ``doc_id, start`` (its ids before the piece), ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset`` (in the sequence) and, unless ``with_ids`` is off, ``ids``.
    Every sequence but the last is full. ``cache_words``: words a Python worker keeps the ids of
    (see ``text_encoder``); fewer take less memory and more time.
    """
    if length < 1:
        raise ValueError("length must be positive")
    tokenizer = tokenizer or vocabulary_path("word_bpe_49k.json")
    encoded = keep(encode_partitions(docs, tokenizer, end_id, id_col, text_col, cache_words), "pack", BATCH_ROWS)
    totals = encoded.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # One row per partition of the written table: bounded by the task count, not by the rows.
    offsets = F.broadcast(running_offsets(totals, "part", "total", "before"))

    def run(batches):
        import pyarrow as pa
        names = [f.split()[0] for f in PIECES.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.binary()]
        worker_held()       # the words are no longer needed
        for b in batches:
            for i in range(0, b.num_rows, BATCH_ROWS):
                some = b.slice(i, BATCH_ROWS)
                cols: list[list] = [[] for _ in names]
                for doc, first, n, data in zip(*(some.column(c).to_pylist() for c in range(4))):
                    ids, done = ids_of(data), 0
                    while done < n:
                        seq, off = divmod(first + done, length)
                        take = min(n - done, length - off)
                        got = ids[done:done + take]
                        row = (doc, done, take, crc_of(got), n, seq, off,
                               got.tobytes() if with_ids else None)
                        for c, v in zip(cols, row):
                            c.append(v)
                        done += take
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
        give_back()

    pieces = (encoded.join(offsets, "part")
              .select("doc_id", (F.col("before") + F.col("local_start")).alias("first"),
                      "n_tokens", "ids")
              .mapInArrow(run, PIECES))
    return pieces if with_ids else pieces.drop("ids")


def assemble(pieces: DataFrame, pad_id: int = 0, length: int = 4096) -> DataFrame:
    """``sequence_id, ids, n_ids``: whole sequences from pieces, padded to ``length`` unless the
    number of ids is a power of two. A sequence gathers at most ``length`` ids."""
    def run(key, table):
        import numpy as np
        import pyarrow as pa
        t = table.sort_by("offset")
        ids = np.concatenate([ids_of(x) for x in t.column("ids").to_pylist()]).astype("<i4")
        n = len(ids)
        if n & (n - 1):
            ids = np.concatenate([ids, np.full(length - n, pad_id, "<i4")])
        return pa.table({"sequence_id": [key[0].as_py()], "ids": pa.array([ids.tolist()], pa.list_(pa.int32())),
                         "n_ids": pa.array([n], pa.int64())})

    return (pieces.select("sequence_id", "offset", "ids").groupBy("sequence_id")
            .applyInArrow(run, "sequence_id long, ids array<int>, n_ids long"))
