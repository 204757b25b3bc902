"""WARC output and a chunked record table.

Writing: payloads are grouped by digest; of equal payloads of at least ``min_bytes`` the one
with the smallest id is a ``response`` and the others are ``revisit`` records that name it.
Equal payloads are matched on (digest, length, salt), so a payload that a third of all rows
share is spread over tasks. Each task writes gzip-per-record files under a name of its own
attempt; the list of files is a Spark table, so exactly one attempt's files are listed.

Reading: a record is never held whole. Its block is inflated and passed on in chunks of at
most ``chunk`` bytes: rows ``record id, chunk number, content, bytes so far, SHA-256 so far,
last``. The last row's running digest is the payload's, and it is checked against the header.

A revisit record has an empty block; its headers carry the payload's digest, its length and
the id of the response. Edge cases: a null or empty payload is an empty response; a null id is
written as an absent header and read back as null, and is never the smallest: its record revisits
the response if there is one; rows repeating an id are separate records (all rows of the smallest
id are responses); an empty table gives no file and no row;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import keep, open_fs, per_key_to_rows, shared_path, tasks_of

MANIFEST = "part int, path string, n_records long, n_bytes long"
CHUNKS = ("page_id long, record_id string, record_type string, refers_to long, chunk_no long, content binary, "
          "payload_bytes long, payload_digest string, is_last boolean")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                 min_bytes: int = 100, broadcast_rows: int = 100_000) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: revisits name the first equal payload. At most
    ``broadcast_rows`` rows of two ids and a digest (about 100 bytes each) are ever broadcast."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    digest = F.sha2("payload", 256)
    # Only ids and digests are grouped. Rows without repeats need no answer: a response.
    keys = rows.select("page_id", digest.alias("digest"), F.length("payload").alias("n")).filter(F.col("n") >= min_bytes)
    # A null id is never the smallest: its rows revisit the response where there is one.
    known = per_key_to_rows(keys.select("page_id", "digest"), ["digest"], "page_id", [F.min], ["page_id"])
    revisit = F.col("page_id").isNull() & F.col("_all_page_id").isNotNull() | (F.col("page_id") > F.col("_all_page_id"))
    firsts = (known.filter(revisit)
              .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"),
                      F.col("_all_page_id").alias("refers_to")).distinct())
    firsts = keep(firsts, "revisits")
    # Few revisits (a checked count) go to every task, so payloads are not shuffled; many are joined.
    if firsts.count() <= broadcast_rows:
        firsts = F.broadcast(firsts)
    return (rows.withColumn("digest", digest)
            .join(firsts, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
            .select("page_id", "url", "payload", "digest", "refers_to"))


def write_warc(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", min_bytes: int = 100, level: int = 1) -> DataFrame:
    """Write one record per row; returns the table of written files."""
    folder = folder or shared_path(pages.sparkSession, "warc")
    plan = plan_records(pages, id_col, url_col, payload_col, min_bytes)

    def run(batches):
        import uuid
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext
        part, out, n_rec, n_byte, name = TaskContext.get().partitionId(), None, 0, 0, None
        step = 1 << 20
        for b in batches:
            cols = [b.column(k) for k in range(5)]
            for i in range(b.num_rows):
                page, url, digest, refers = (cols[k][i].as_py() for k in (0, 1, 3, 4))
                body = memoryview(cols[2][i].as_buffer() or b"") if refers is None else memoryview(b"")
                size = cols[2][i].as_buffer().size if cols[2][i].as_buffer() is not None else 0
                head = ["WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
                        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{part}/{n_rec}/{page}')}>",
                        "WARC-Date: 1970-01-01T00:00:00Z",
                        f"WARC-Target-URI: {(url or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
                        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}"]
                if page is not None:
                    head.append(f"X-Page-ID: {page}")
                if refers is not None:
                    head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                             f"X-Refers-To-Page-ID: {refers}"]
                head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
                if out is None:
                    fs, base = open_fs(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"part-{part:05d}-{uuid.uuid4().hex[:12]}.warc.gz"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                z = zlib.compressobj(level, zlib.DEFLATED, 31)
                pieces = [z.compress("\r\n".join(head).encode("utf-8", "surrogatepass"))]
                pieces += [z.compress(body[k:k + step]) for k in range(0, len(body), step)]
                pieces += [z.compress(b"\r\n\r\n"), z.flush()]
                for p in pieces:
                    out.write(p)
                    n_byte += len(p)
                n_rec += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"],
                                              "n_records": [n_rec], "n_bytes": [n_byte]})

    return keep(plan.mapInArrow(run, MANIFEST), "warc-files")


def read_chunks(manifest: DataFrame, chunk: int = 1 << 20, with_content: bool = True) -> DataFrame:
    """The chunked record table of the listed files, one task per file at a time."""
    def run(batches):
        import hashlib
        import zlib

        import pyarrow as pa
        names = [f.split()[0] for f in CHUNKS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(),
                 pa.bool_()]

        def records(stream):
            """(headers, iterator of block pieces) of each gzip member."""
            raw = b""
            while True:
                if not raw:
                    raw = stream.read(1 << 18)
                    if not raw:
                        return
                z = zlib.decompressobj(31)
                state = {"raw": raw}

                def more(limit=1 << 18):
                    while not z.eof:
                        if not state["raw"]:
                            state["raw"] = stream.read(1 << 18)
                            if not state["raw"]:
                                raise ValueError("archive ends inside a record")
                        got = z.decompress(state["raw"], limit)
                        state["raw"] = z.unused_data if z.eof else z.unconsumed_tail
                        if got:
                            return got
                    return b""

                buf = b""
                while b"\r\n\r\n" not in buf:
                    got = more()
                    if not got:
                        raise ValueError("record without header")
                    buf += got
                top, _, rest = buf.partition(b"\r\n\r\n")
                head = dict(x.split(": ", 1) for x in top.decode("utf-8", "surrogatepass").split("\r\n")[1:])

                def block(rest=rest, left=int(head["Content-Length"])):
                    while left:
                        if not rest:
                            rest = more()
                            if not rest:
                                raise ValueError("record shorter than its length")
                        yield rest[:left]
                        left, rest = left - len(rest[:left]), rest[left:]

                yield head, block()
                while more():       # the closing blank lines
                    pass
                raw = state["raw"]

        def chunks(head, pieces):
            revisit = head["WARC-Type"] == "revisit"
            sha, size, no, buf = hashlib.sha256(), 0, 0, bytearray()
            fixed = [int(head["X-Page-ID"]) if "X-Page-ID" in head else None, head["WARC-Record-ID"], head["WARC-Type"],
                     int(head["X-Refers-To-Page-ID"]) if revisit else None]
            for p in pieces:
                buf += p
                while len(buf) > chunk:
                    piece = bytes(buf[:chunk])
                    del buf[:chunk]
                    sha.update(piece)
                    size += len(piece)
                    yield [*fixed, no, piece if with_content else None, size, sha.hexdigest(), False]
                    no += 1
            sha.update(buf)
            size += len(buf)
            want = head["WARC-Payload-Digest"].removeprefix("sha256:")
            if revisit:
                yield [*fixed, no, None, int(head["X-Payload-Length"]), want, True]
                return
            if sha.hexdigest() != want or size != int(head["X-Payload-Length"]):
                raise ValueError(f"payload differs from its digest: {head['WARC-Record-ID']}")
            yield [*fixed, no, bytes(buf) if with_content else None, size, want, True]

        for b in batches:
            for path in b.column(0).to_pylist():
                fs, base = open_fs(path)
                with fs.open_input_stream(base, compression=None) as stream:
                    rows, held = [], 0
                    for head, pieces in records(stream):
                        for r in chunks(head, pieces):
                            rows.append(r)
                            held += len(r[5] or b"") + 200
                            if held > 1 << 22:
                                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                                rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = manifest.select("path").repartition(tasks_of(manifest.sparkSession))
    return files.mapInArrow(run, CHUNKS)


def read_records(manifest: DataFrame) -> DataFrame:
    """One row per record: the last chunk carries the whole payload's length and digest."""
    return (read_chunks(manifest, with_content=False).filter("is_last")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
