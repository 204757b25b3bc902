"""URL filters by a temporal list join, with DataFrame functions only.

A list is a set of dated entries ``pattern, day, action`` (``add`` or ``remove``). Per pattern
and day the last entry counts; each becomes a validity interval ``[day, next entry's day)``, the
last one open. Every capture is evaluated against the intervals that hold on its fetch day, by
an as-of join: its candidate patterns (exact page, first path segment, host and every parent
domain of two labels or more; userinfo, port and closing dots are no part of a host, and an IP
address has no parents) are merged with the interval starts and the last start is carried
forward. A capture is blocked when an ``add`` interval of any candidate holds; the rule reported
is the most specific one.

Work is done once per distinct (url, day) and (pattern, day). A pattern has at most one
interval and one probe per calendar day, so the carried window is bounded by the calendar, and
all joins back to many rows are on (key, salt), so a host that a third of all captures share is
spread over tasks.

Edge cases: a null or unparsable url and a null day match nothing; entries with a null pattern
or day are ignored; ties on (pattern, day) go to the largest ``order``; repeated captures each
get a row; empty tables are fine on either side; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlink.llm.common import salt_of, tasks_of


def url_patterns(url: Column) -> Column:
    """Candidate patterns of a url, most specific first: ``u:`` page, ``p:`` first segment,
    ``d:`` host and parent domains. Null when the url has no host."""
    bare = F.regexp_replace(F.lower(url), "[?#].*$", "")
    authority = F.regexp_extract(bare, "^[a-z][a-z0-9+.-]*://([^/]+)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r"\.*(:[0-9]*)?$", "")
    path = F.regexp_extract(bare, "^[a-z][a-z0-9+.-]*://[^/]+(/.*)$", 1)
    segment = F.regexp_extract(path, "^/([^/]+)", 1)
    labels = F.split(host, "\\.")
    n = F.when(host.rlike(r"^([0-9.]+|\[.*)$"), 1).otherwise(F.size(labels))
    parents = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)),
                          lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    return F.when(host != "", F.concat(F.array(F.concat(F.lit("u:"), host, path),
                                               F.concat(F.lit("p:"), host, F.lit("/"), segment)), parents))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``pattern, start, stop, action, entry``: one interval per (pattern, day); ``stop`` is null
    for the last. Input columns: pattern, day, action, order (ties go to the largest)."""
    last = (entries.filter(F.col("pattern").isNotNull() & F.col("day").isNotNull())
            .groupBy("pattern", "day").agg(F.max(F.struct("order", "action")).alias("e")))
    w = Window.partitionBy("pattern").orderBy("day")        # at most one row per calendar day
    return last.select("pattern", F.col("day").alias("start"), F.lead("day").over(w).alias("stop"),
                       F.col("e.action").alias("action"), F.col("e.order").alias("entry"))


def as_of(probes: DataFrame, intervals: DataFrame) -> DataFrame:
    """``pattern, day`` with the interval that holds on the day (``start, stop, action, entry``);
    probes before a pattern's first interval are dropped."""
    mark = F.struct("start", "stop", "action", "entry")
    marks = intervals.select("pattern", F.col("start").alias("day"), F.lit(0).alias("probe"), mark.alias("i"))
    asks = probes.select("pattern", "day", F.lit(1).alias("probe"), F.lit(None).cast(marks.schema["i"].dataType).alias("i"))
    w = (Window.partitionBy("pattern").orderBy("day", "probe")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (marks.unionByName(asks).withColumn("i", F.last("i", ignorenulls=True).over(w))
            .filter((F.col("probe") == 1) & F.col("i").isNotNull()).select("pattern", "day", "i.*"))


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
             day_col: str = "day") -> DataFrame:
    """``page_id, day, n_active, blocked, rule, listed_on, entry`` per capture."""
    n = 4 * tasks_of(captures.sparkSession)
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"),
                           F.col(day_col).alias("day"))
    rows = rows.withColumn("_s", salt_of(F.coalesce(F.col("page_id").cast("string"), F.lit("")), n))
    cells = rows.filter(F.col("url").isNotNull() & F.col("day").isNotNull()).select("url", "day", "_s").distinct()
    found = F.posexplode(url_patterns(F.col("url"))).alias("place", "pattern")
    asked = (cells.select("url", "day").distinct().select("url", "day", found)
             .withColumn("_t", salt_of(F.col("url"), n)))
    spots = asked.select("pattern", "day", "_t").distinct()
    held = as_of(spots.select("pattern", "day").distinct(), validity_intervals(entries)).filter(F.col("action") == "add")
    spread = spots.join(held, ["pattern", "day"])
    per_url = (asked.join(spread, ["pattern", "day", "_t"]).groupBy("url", "day")
               .agg(F.count("*").alias("n_active"), F.min(F.struct("place", "pattern", "start", "entry")).alias("best")))
    per_cell = cells.join(per_url, ["url", "day"])
    return (rows.join(per_cell, ["url", "day", "_s"], "left")
            .select("page_id", "day", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
                    F.col("best").isNotNull().alias("blocked"), F.col("best.pattern").alias("rule"),
                    F.col("best.start").alias("listed_on"), F.col("best.entry").alias("entry")))


# The tables hold no list and no fetch time; both are derived from every page, so they grow with
# the input: a capture's day and an entry's day, pattern kind and action come from the page id.
DAYS = 1461


def derived_entries(pages: DataFrame) -> DataFrame:
    kinds = url_patterns(F.col("url"))
    kind = F.col("page_id") % 4
    at = F.when(kind == 0, 1).when(kind == 1, 2).when(kind == 2, 3).otherwise(F.size(kinds))
    return pages.select(F.element_at(kinds, at).alias("pattern"),
                        ((F.col("page_id") * 7919 + 11) % DAYS).alias("day"),
                        F.when(F.col("page_id") * 31 % 3 == 0, "remove").otherwise("add").alias("action"),
                        F.col("page_id").alias("order"))


def derived_captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", ((F.col("page_id") * 104729 + 17) % DAYS).alias("day"))


SQL = f"""
WITH parsed AS (
  SELECT page_id, url, regexp_replace(lower(url), '[?#].*$', '') AS bare FROM pages),
authorities AS (
  SELECT page_id, url, split_part(split_part(bare, '://', 2), '/', 1) AS authority,
         CASE WHEN strpos(split_part(bare, '://', 2), '/') > 0
              THEN substr(split_part(bare, '://', 2), strpos(split_part(bare, '://', 2), '/')) ELSE '' END AS path
  FROM parsed WHERE regexp_matches(bare, '^[a-z][a-z0-9+.-]*://')
  UNION ALL SELECT page_id, url, '', '' FROM parsed WHERE url IS NULL OR NOT regexp_matches(bare, '^[a-z][a-z0-9+.-]*://')),
hosts AS (
  SELECT page_id, url, rtrim(split_part(list_last(string_split(authority, '@')), ':', 1), '.') AS host, path FROM authorities),
candidates AS (
  SELECT page_id, url, CASE WHEN host <> '' THEN
    list_concat(['u:' || host || path, 'p:' || host || '/' || regexp_extract(path, '^/([^/]+)', 1)],
      list_transform(range(1, CASE WHEN translate(host, '0123456789.', '') = '' THEN 2
                            ELSE greatest(1, len(string_split(host, '.')) - 1) + 1 END),
        lambda i: 'd:' || array_to_string(list_slice(string_split(host, '.'), i, len(string_split(host, '.'))), '.'))) END AS pats
  FROM hosts),
entries AS (
  SELECT pats[CASE page_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE len(pats) END] AS pattern,
         (page_id * 7919 + 11) % {DAYS} AS day, CASE WHEN page_id * 31 % 3 = 0 THEN 'remove' ELSE 'add' END AS action,
         page_id AS ord
  FROM candidates),
daily AS (
  SELECT pattern, day AS start, arg_max(action, ord) AS action, max(ord) AS entry FROM entries
  WHERE pattern IS NOT NULL GROUP BY pattern, day),
intervals AS (
  SELECT *, lead(start) OVER (PARTITION BY pattern ORDER BY start) AS stop FROM daily),
asks AS (
  SELECT page_id, (page_id * 104729 + 17) % {DAYS} AS day, unnest(pats) AS pattern,
         unnest(range(len(pats))) AS place FROM candidates),
held AS (
  SELECT a.page_id, a.place, a.pattern, i.start, i.entry FROM asks a
  JOIN intervals i ON a.pattern = i.pattern AND a.day >= i.start AND (i.stop IS NULL OR a.day < i.stop)
  WHERE i.action = 'add'),
best AS (
  SELECT page_id, count(*) AS n_active, arg_min(pattern, place) AS rule, arg_min(start, place) AS listed_on,
         arg_min(entry, place) AS entry FROM held GROUP BY page_id)
SELECT p.page_id, (p.page_id * 104729 + 17) % {DAYS} AS day, coalesce(b.n_active, 0) AS n_active,
       b.page_id IS NOT NULL AS blocked, b.rule, b.listed_on, b.entry
FROM pages p LEFT JOIN best b USING (page_id)
"""
