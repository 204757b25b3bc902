"""Quality rules by weak supervision.

Each rule votes good (1), bad (0) or abstains (null) on a document. Expectation-maximisation
over all documents' votes estimates, per rule, how often it votes each way on good and on bad
documents, and the share of good documents (the two-class model of Dawid and Skene, abstentions
carrying no evidence). The posterior probability of quality replaces "must pass all rules".

The votes of all documents are counted by vote pattern in Spark. There are at most
``3 ** len(RULES)`` patterns, whatever the number of documents, and the estimate runs on those
counts on the driver. Two narrow passes, no row is shuffled but the pattern counts.

Edge cases: a null or empty text has zero words and fails the base; null ids and repeated rows
are kept as they are, one verdict each; an empty table returns no rows; other columns pass
through ``quality`` untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlink.llm.common import arrow_schema, give_back, keep, worker_held

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_distinct", "n_plain_words", "n_upper", "n_letters", "n_punct", "n_bytes", "n_stops"]
STATS = "_llm_quality"


def _text_counts():
    """A function text -> the counts above; made inside the task."""
    import string

    import numpy as np
    punct = string.punctuation.encode()
    upper, lower = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
    blanks, symbols = " \t\n\r\x0b\x0c", "#*$%&|<>"

    def count(text: str | None) -> list[int]:
        if not text:
            return [0] * 13
        data = text.encode("utf-8", "surrogatepass")
        words = data.split()                    # bytes: blank, tab, newline, \v, \f, \r only
        n = len(words)
        lines = [x for x in data.split(b"\n") if x.strip()]
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
        repeated = 0
        if n >= 4:
            v = len(seen)
            if v < 2_000_000:
                code = (ids[:-2] * v + ids[1:-1]) * v + ids[2:]
            else:
                _, pair = np.unique(ids[:-2] * v + ids[1:-1], return_inverse=True)
                code = pair.astype(np.int64) * v + ids[2:]
            order = np.argsort(code, kind="stable")
            same = code[order[1:]] == code[order[:-1]]
            if same.any():
                twice = np.zeros(n - 2, bool)
                twice[order[1:][same]] = True
                twice[order[:-1][same]] = True
                in_window = np.zeros(n, bool)
                for k in range(3):
                    in_window[k:n - 2 + k] |= twice
                repeated = int(in_window.sum())
        bare = np.fromiter((not w.translate(None, punct) for w in seen), bool, len(seen))
        plain = n - int(bare[ids].sum()) if n else 0
        return [n, len(text) - sum(map(text.count, blanks)), sum(map(text.count, symbols)),
                len(lines) - len(set(lines)), repeated, len(lines), len(seen), plain,
                len(data) - len(data.translate(None, upper)),
                len(data) - len(data.translate(None, upper + lower)),
                len(data) - len(data.translate(None, punct)), len(data),
                sum(map(text.count, ".!?。…"))]

    return count


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with a struct column of the text's counts; all columns pass through."""
    struct = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
    schema = docs.select("*", F.lit(None).cast(struct).alias(STATS)).schema
    at = docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa
        count, target = _text_counts(), arrow_schema(schema)
        kind = target.field(target.names.index(STATS)).type
        worker_held()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                piece = b.slice(lo, 512)
                rows = [count(t) for t in piece.column(at).to_pylist()]
                cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]
                stat = pa.StructArray.from_arrays(cols, fields=[kind.field(i) for i in range(kind.num_fields)])
                yield pa.RecordBatch.from_arrays([*piece.columns, stat], names=target.names)
        give_back()

    return docs.mapInArrow(run, schema)


def _s(name: str) -> Column:
    return F.col(f"{STATS}.{name}")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1)


def rules() -> dict[str, Column]:
    """Name -> vote. Shares are compared as integers, so votes are exact."""
    n, long_enough = _s("n_words"), _s("n_words") >= 20
    mean = 10 * _s("word_chars")
    per_stop = _s("n_words")
    return {
        "length": _vote(n >= 100, n < 50),
        "word_length": _vote((mean >= 30 * n) & (mean <= 100 * n) & (n > 0), (mean < 20 * n) | (mean > 140 * n)),
        "symbols": _vote(50 * _s("n_symbols") <= n, 10 * _s("n_symbols") > n),
        "bare_words": _vote(100 * _s("n_plain_words") >= 97 * n, 100 * _s("n_plain_words") < 85 * n),
        "punctuation": _vote(100 * _s("n_punct") <= 8 * _s("n_bytes"), 100 * _s("n_punct") > 15 * _s("n_bytes")),
        "capitals": _vote(100 * _s("n_upper") <= 20 * _s("n_letters"), 100 * _s("n_upper") > 50 * _s("n_letters")),
        "sentences": _vote(long_enough & (_s("n_stops") * 60 >= per_stop) & (_s("n_stops") * 3 <= per_stop),
                           long_enough & ((_s("n_stops") * 150 < per_stop) | (_s("n_stops") > per_stop))),
        "duplicate_lines": _vote((_s("n_lines") >= 2) & (10 * _s("n_dup_lines") <= _s("n_lines")),
                                 (_s("n_lines") >= 5) & (10 * _s("n_dup_lines") > 3 * _s("n_lines"))),
        "repeated_windows": _vote(100 * _s("n_repeat_words") <= 10 * n, 100 * _s("n_repeat_words") > 35 * n),
        "variety": _vote(100 * _s("n_distinct") >= 20 * n, long_enough & (n <= 2000) & (100 * _s("n_distinct") < 10 * n)),
    }


def _code(votes: dict[str, Column]) -> Column:
    return F.concat(*[F.coalesce(v.cast("string"), F.lit("-")) for v in votes.values()])


def estimate(patterns: dict[str, int], rounds: int = 60) -> tuple[float, list[tuple[float, float]]]:
    """Expectation-maximisation over vote patterns.

    Returns the share of good documents and, per rule, P(bad vote | bad), P(bad vote | good)
    among votes given. Starts from "the more bad votes, the likelier bad"; rates are smoothed
    by pseudo-counts and a rule may not be worse than chance (P(bad vote | bad) at least
    P(bad vote | good)), which keeps the two classes from changing places.
    """
    keys = sorted(patterns)
    if not keys:
        return 0.5, []
    m = len(keys[0])
    weight = [float(patterns[k]) for k in keys]
    total = sum(weight)
    good = [0.97 if "0" not in k else (0.4 if k.count("0") == 1 else 0.03) for k in keys]
    prior, rates = 0.5, [(0.5, 0.5)] * m
    for _ in range(rounds):
        prior = min(0.999, max(0.001, (sum(w * g for w, g in zip(weight, good)) + 1) / (total + 2)))
        rates = []
        for r in range(m):
            counts = [[0.0, 0.0], [0.0, 0.0]]           # [class][vote]
            for k, w, g in zip(keys, weight, good):
                if k[r] != "-":
                    v = k[r] == "1"
                    counts[0][v] += w * (1 - g)
                    counts[1][v] += w * g
            bad, fine = [(c[0] + p) / (c[0] + c[1] + 1.0) for c, p in zip(counts, (0.3, 0.02))]
            bad, fine = min(0.999, max(0.001, bad)), min(0.999, max(0.001, fine))
            rates.append((max(bad, fine), fine))
        good = [1 / (1 + math.exp(-_log_odds(k, prior, rates))) for k in keys]
    return prior, rates


def _log_odds(key: str, prior: float, rates) -> float:
    x = math.log(prior / (1 - prior))
    for c, (bad, fine) in zip(key, rates):
        if c == "0":
            x += math.log(fine / bad)
        elif c == "1":
            x += math.log((1 - fine) / (1 - bad))
    return max(-700.0, min(700.0, x))


def _posterior(votes: dict[str, Column], prior: float, rates) -> Column:
    x = F.lit(math.log(prior / (1 - prior)))
    for v, (bad, fine) in zip(votes.values(), rates):
        x = x + F.when(v == 0, math.log(fine / bad)).when(v == 1, math.log((1 - fine) / (1 - bad))).otherwise(0.0)
    return 1 / (1 + F.exp(-x))


def base_failed() -> Column:
    return (_s("n_words") < 50) | (100 * _s("n_repeat_words") > 50 * _s("n_words"))


def quality_model(counted: DataFrame) -> tuple[float, list[tuple[float, float]]]:
    """Estimate from all rows that carry the counts struct: one aggregate by vote pattern."""
    rows = counted.groupBy(_code(rules()).alias("votes")).count().collect()   # at most 3 ** 10 patterns
    return estimate({r["votes"]: r["count"] for r in rows})


def judged(counted: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """``counted`` with ``p_quality``, ``base_failed`` and ``kept``."""
    prior, rates = model
    p = _posterior(rules(), prior, rates) if rates else F.lit(prior)
    return (counted.select("*", p.alias("p_quality"), base_failed().alias("base_failed"))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_quality") >= threshold)))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.5) -> DataFrame:
    """Counts, votes' posterior and verdict per row. The counts (13 integers a row) are written
    once and read for the estimate and for the verdicts."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = keep(with_counts(narrow).drop("text"), "quality")
    out = judged(counted, quality_model(counted), threshold)
    return out.select("doc_id", *[_s(c).alias(c) for c in COUNTS[:5]], "base_failed", "kept", "p_quality")


def quality_filter(docs: DataFrame, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that pass, with exactly the columns of ``docs``. The first pass keeps
    only the counts for the estimate; the second counts again and filters, so texts are neither
    shuffled nor copied, and repeated or null ids need no join."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    model = quality_model(keep(with_counts(texts).drop("text"), "quality"))
    return judged(with_counts(docs, text_col), model, threshold).filter("kept").select(*docs.columns)
