"""Filter interaction audit with a counting-Bloom duplicate prepass.

Five filters judge every document: A fewer than 200 words, B distinct words below half of the words,
C capital letters above 2 % of the code points, D any of ``#$%&*|``, E the text of a smaller id.
For every source and each of the 120 orders the report says, step by step, what a filter removes,
what it finds already removed, what only it catches, and what good and toxic documents it costs.

1. *Flags.* One pass keeps a narrow row per document: id, part, failure mask of A to D, text hash.
2. *Prepass.* Every task counts its texts in a sparse counting-Bloom sketch (``HASHES`` counters a
   text, saturating at two, ``SLOTS_PER_ROW`` counters a row). The sketches are merged shard by
   shard; a text with a counter at one is guaranteed unique. What remains, one bit a counter, is
   broadcast: at most ``most_slots`` bits (128 MB). A table with more rows than that serves gets
   fewer counters a row, so more unique texts pass for possible repeats; the result is the same.
3. *Exact minima.* Only possible repeats are read again with their texts and shuffled: the minimum
   id per full text (partial minima first, so a hot text is one row a task).
4. *Masks.* A possible repeat fails E unless it holds the minimum id, a lookup by (128 bits of text
   hash, id), so that a group of copies, however large, is spread by its ids. Masks and labels are
   counted per (part, mask): at most 32 additive counts a part, from which all 600 steps follow.

Edge cases: a null text is empty, so nulls and empty texts are copies of each other; a row with a
null id neither fails E nor makes others fail it and has no label; rows repeating an id are
documents of their own, and copies under the same id are not duplicates of each other; a document
is good (toxic) if any label row of its id says so; a null source and an empty one are the part
``''``; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import keep, tasks_of

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
HASHES, SLOTS_PER_ROW = 3, 16
TEXT_KEY = ["hash", "check"]


def _hashed(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``doc_id, part, text, hash, check``; the same hashes in both passes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        text.alias("text"))
            .withColumns({"hash": F.xxhash64("text"), "check": F.xxhash64(F.char_length("text"), "text")}))


def _flagged(source: DataFrame) -> DataFrame:
    """``doc_id, part, mask, hash, check`` with the failure mask of A to D, bit i for filter i."""
    text, n = F.col("text"), F.size("_words")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 200, 100 * F.size(F.array_distinct("_words")) < 50 * n, 100 * capitals > 2 * F.char_length(text),
             text.rlike("[#$%&*|]")]
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return (source.withColumn("_words", F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
            .select("doc_id", "part", mask.alias("mask"), *TEXT_KEY))


def _slots(hashes, n_slots: int):
    """The counters of each hash: ``HASHES`` places below ``n_slots``, a power of two."""
    import numpy as np
    mul, low = np.uint64(0x9E3779B97F4A7C15), np.uint64(n_slots - 1)
    with np.errstate(over="ignore"):
        first = hashes * mul
        step = ((hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
        places = first[:, None] + np.arange(HASHES, dtype=np.uint64)[None, :] * step[:, None]
        return (places >> np.uint64(20)) & low


def repeat_sketch(flags: DataFrame, rows: int, most_slots: int = 1 << 30):
    """``(bits, slots)``: bit i is set where counter i of the merged sketch is two or more."""
    import numpy as np
    slots = min(1 << max(16, (SLOTS_PER_ROW * max(1, rows) - 1).bit_length()), most_slots)
    # Shards of the sketch, merged apart: a power of two, of 2^13 to 2^20 counters where it can be.
    shards = max(1, min(slots >> 13, max(tasks_of(flags.sparkSession), slots >> 20)))
    shards = 1 << (shards.bit_length() - 1)
    width = slots // shards

    def count(batches):
        """Sparse sketches of a task's texts: places by shard, and whether they are at two already."""
        import numpy as np
        import pyarrow as pa

        def emit(pending):
            places, times = np.unique(_slots(np.concatenate(pending), slots).ravel(), return_counts=True)
            shard, local = (places // np.uint64(width)).astype(np.int32), (places % np.uint64(width)).astype(np.uint32)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            spans = list(zip(cuts, cuts[1:]))
            return pa.RecordBatch.from_arrays(
                [pa.array(shard[cuts[:-1]]), pa.array([local[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([np.packbits(times[a:b] > 1).tobytes() for a, b in spans], pa.binary())],
                names=["shard", "places", "often"])

        pending, held = [], 0
        for b in batches:
            if b.num_rows:
                pending.append(b.column(0).to_numpy().view(np.uint64))
                held += b.num_rows
            if held >= 500_000:
                yield emit(pending)
                pending, held = [], 0
        if pending:
            yield emit(pending)

    def merge(table):
        """One shard: the counters added, then one bit for each that is two or more."""
        import numpy as np
        import pyarrow as pa
        counters = np.zeros(width, np.uint8)
        for places, often in zip(table.column("places").to_pylist(), table.column("often").to_pylist()):
            at = np.frombuffer(places, np.uint32)
            counters[at] = np.minimum(counters[at] + 1 + np.unpackbits(np.frombuffer(often, np.uint8), count=len(at)), 2)
        return pa.table({"shard": table.column("shard")[:1], "bits": pa.array([np.packbits(counters > 1).tobytes()], pa.binary())})

    merged = (flags.select("hash").mapInArrow(count, "shard int, places binary, often binary")
              .groupBy("shard").applyInArrow(merge, "shard int, bits binary"))
    bits = np.zeros(slots // 8, np.uint8)
    for r in merged.toLocalIterator():              # slots / 8 bytes in all, a fixed bound
        part = np.frombuffer(r["bits"], np.uint8)
        bits[r["shard"] * (width // 8):][:len(part)] = part
    return bits, slots


def _may_repeat(spark, bits, slots: int):
    """Column function hash -> whether a row's text may stand elsewhere too."""
    from pyspark.sql.pandas.functions import pandas_udf
    shared = spark.sparkContext.broadcast(bits)         # at most most_slots bits

    def look_up(hashes):
        import numpy as np
        import pandas as pd
        table, at = shared.value, _slots(hashes.to_numpy(np.int64).view(np.uint64), slots)
        bit = table[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)
        return pd.Series((bit & 1).all(axis=1))

    return pandas_udf(look_up, "boolean")


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                  most_slots: int = 1 << 30) -> DataFrame:
    """``doc_id, part, mask, c``: the failure masks (bit i for filter i of A to E), and how many
    rows of the table each line stands for."""
    source = _hashed(docs, id_col, text_col, part_col)
    flags = keep(_flagged(source), "flags")
    bits, slots = repeat_sketch(flags, flags.count(), most_slots)
    may_repeat = _may_repeat(docs.sparkSession, bits, slots)
    firsts = (source.filter(may_repeat("hash")).groupBy(*TEXT_KEY, "text").agg(F.min("doc_id").alias("doc_id"))
              .select(*TEXT_KEY, "doc_id", F.lit(True).alias("first")).distinct())
    marked = flags.withColumn("may", may_repeat("hash"))
    # Rows of one text and id collapse first; the rest of a group of copies differ by id.
    groups = marked.filter("may").groupBy(*TEXT_KEY, "doc_id", "part", "mask").agg(F.count("*").alias("c"))
    copied = F.col("first").isNull() & F.col("doc_id").isNotNull()
    judged = (groups.join(firsts, [*TEXT_KEY, "doc_id"], "left")
              .select("doc_id", "part", (F.col("mask") + F.when(copied, REPEATED).otherwise(0)).alias("mask"), "c"))
    return marked.filter("not may").select("doc_id", "part", "mask", F.lit(1).cast("long").alias("c")).unionByName(judged)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: additive counts, at most 32 lines a part."""
    masks = keep(masks, "masks")
    marks = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*marks).filter("good + toxic > 0")
    # A hot id is a few lines before it meets its label; null ids have none.
    met = (masks.filter("doc_id is not null").groupBy("doc_id", "part", "mask").agg(F.sum("c").alias("c")).join(marked, "doc_id")
           .select("part", "mask", F.lit(0).cast("long").alias("n"), (F.col("c") * F.col("good")).alias("good"), (F.col("c") * F.col("toxic")).alias("toxic")))
    zero = F.lit(0).cast("long")
    return (masks.select("part", "mask", F.col("c").alias("n"), zero.alias("good"), zero.alias("toxic")).unionByName(met)
            .groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]))


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of the step's filter, bits of the filters before it) of all 120 orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def audit(counts: DataFrame) -> DataFrame:
    """The report of ``mask_counts``: one row per part, order and step."""
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(p).alias("before"))
                      for o, s, b, p in _steps()])
    parts = (counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("m"))      # 32 at most
             .select("part", "m", F.explode(steps).alias("s")).select("part", "m", "s.*"))
    bit, before = F.col("bit"), F.col("before")

    def total(where, value):
        return F.aggregate("m", F.lit(0).cast("long"), lambda acc, x: acc + F.when(where(x["mask"]), value(x)).otherwise(0))

    def removed(m):
        return (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) == 0)

    share = len(list(permutations(FILTERS)))
    return parts.select(
        "part", "filter_order", "step",
        total(lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0, lambda x: x["n"]).alias("kept"),
        total(removed, lambda x: x["n"]).alias("removed"),
        total(lambda m: (m.bitwiseAND(bit) != 0) & (m.bitwiseAND(before) != 0), lambda x: x["n"]).alias("redundant"),
        total(lambda m: m == bit, lambda x: x["n"]).alias("unique_fails"),
        total(removed, lambda x: x["good"]).alias("good_lost"),
        total(removed, lambda x: x["toxic"]).alias("toxic_lost"),
        # of a mask with k bits, each filter is first in 1 / k of the orders
        total(lambda m: m.bitwiseAND(bit) != 0, lambda x: x["n"] * F.floor(share / F.bit_count(x["mask"]))).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Masks, counts and report in one call."""
    return audit(mask_counts(failure_masks(docs), labels))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS low FROM d),
f AS (SELECT doc_id, part,
        (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END)
        || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
        || (CASE WHEN low < doc_id THEN 'E' ELSE '' END) AS fails FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS now, substr(filter_order, 1, step - 1) AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, n, good, toxic, fails, contains(fails, now) AS hit, fails = now AS alone,
        len(list_intersect(string_split(fails, ''), string_split(before, ''))) > 0 AND fails <> '' AND before <> '' AS gone
      FROM c, s),
p AS (SELECT part, filter_order, step, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN alone THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost
      FROM r GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)) AS BIGINT) AS shapley
FROM p
"""
