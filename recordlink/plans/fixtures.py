"""Entity-record fixtures derived from the driver's tables.

Each fixture is a DataFrame expression over the parquet tables (so its size grows
with the scale factor) and has a twin SQL text (``FIXTURE_SQL``) that DuckDB runs
for the oracle. ``seq`` is the unique order column of every fixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.plans.catalog import Catalog


def _s(c):
    return c.cast("string")


def fx_registry(cat: Catalog) -> DataFrame:
    """Registry side: many rows per key (outlets), blank and invalid keys, a dash
    in the key, falsy outlet fields. One row per order."""
    o = cat.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = cat.customer.select("c_custkey", "c_name", "c_nationkey")
    n = cat.nation.select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("o_orderkey")
    return j.select(
        k.alias("seq"),
        F.when(k % 97 == 0, F.lit("")).when(k % 89 == 0, F.lit("123"))
        .otherwise(F.concat(F.lit("3-"), _s(F.lit(2000000000) + F.col("o_custkey"))))
        .alias("taxpayer_number"),
        F.col("c_name").alias("taxpayer_name"),
        F.col("n_name").alias("taxpayer_city"),
        F.lit("TX").alias("taxpayer_state"),
        F.lpad(_s(k % 99999), 5, "0").alias("taxpayer_zip"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(_s(F.col("o_custkey")), F.lit(" Commerce St"))).alias("taxpayer_address"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(_s(k)).alias("outlet_number"),
        F.when(k % 5 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("outlet_name"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("outlet_city"),
        F.when(k % 15 == 0, F.lit(None).cast("string"))
        .otherwise(_s(F.col("o_orderdate").cast("date"))).alias("outlet_permit_issue_date"),
    )


def fx_account(cat: Catalog) -> DataFrame:
    """Account side: one row per key; every customer (one market segment under keys the
    registry lacks) plus every supplier (other such keys)."""
    c = cat.customer
    k = F.col("c_custkey")
    series = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("38")).otherwise(F.lit("32"))
    cust = c.select(
        k.alias("seq"),
        F.concat(series, F.lpad(_s(k), 9, "0")).alias("taxpayer_id"),
        F.when(F.col("c_acctbal") < 0, F.lit("INACTIVE")).otherwise(F.lit("ACTIVE")).alias("status"),
        F.col("c_mktsegment").alias("entity_type"),
        F.col("c_acctbal").alias("balance"),
        F.when(k % 4 == 0, F.concat(F.col("c_name"), F.lit(" Holdings Group")))
        .when(k % 4 == 1, F.lit("")).alias("legal_name"),
        F.when(k % 5 == 0, F.concat(_s(k), F.lit(" Market St"))).alias("address"),
        F.concat(F.lit("2020-"), F.lpad(_s(k % 12 + 1), 2, "0"), F.lit("-15")).alias("filing_date"),
    )
    s = cat.supplier
    sk = F.col("s_suppkey")
    sup = s.select(
        (F.lit(1000000) + sk).alias("seq"),
        F.concat(F.lit("39"), F.lpad(_s(sk), 9, "0")).alias("taxpayer_id"),
        F.lit("ACTIVE").alias("status"),
        F.lit("SUPPLIER").alias("entity_type"),
        F.col("s_acctbal").alias("balance"),
        F.col("s_name").alias("legal_name"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("filing_date"),
    )
    return cust.unionByName(sup)


def fx_places(cat: Catalog) -> DataFrame:
    """Place-detail lookups per customer: success, error and no-place-id rows."""
    k = F.col("c_custkey")
    return cat.customer.select(
        k.alias("seq"),
        F.concat(F.lit("32"), F.lpad(_s(k), 9, "0")).alias("taxpayer_id"),
        F.when(k % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("P"), _s(k))).alias("place_id"),
        F.when(k % 11 == 0, F.lit("no_place_id")).when(k % 5 == 0, F.lit("error"))
        .otherwise(F.lit("success")).alias("details_status"),
        F.col("c_name").alias("name"),
        ((k % 50).cast("double") / 10).alias("rating"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("https://example.com/"), _s(k))).alias("website"),
        (k % 500).alias("user_ratings_total"),
    )


def fx_contacts(cat: Catalog) -> DataFrame:
    """Contacts with bad and missing ids, zips, e-mails and phones."""
    k = F.col("c_custkey")
    return cat.customer.select(
        k.alias("seq"),
        F.when(k % 10 == 0, F.lit("12-34")).when(k % 10 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("32"), F.lpad(_s(k % 500), 9, "0"))).alias("taxpayer_id"),
        F.col("c_name").alias("business_name"),
        F.when(k % 4 == 0, F.lit("78701")).when(k % 4 == 1, F.lit("78701-1234"))
        .when(k % 4 == 2, F.lit(" 7870")).otherwise(F.lit("")).alias("zip"),
        F.when(k % 3 == 0, F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                                    F.lit("@example.com")))
        .when(k % 3 == 1, F.lit("bad@")).otherwise(F.lit(None).cast("string")).alias("email"),
        F.when(k % 3 == 0, F.concat(F.lit("512-555-"), F.lpad(_s(k % 10000), 4, "0")))
        .when(k % 3 == 1, F.lit("5551234")).otherwise(F.lit("")).alias("phone"),
    )


FIXTURES = {"fx_registry": fx_registry, "fx_account": fx_account, "fx_places": fx_places,
            "fx_contacts": fx_contacts}

# DuckDB twins of the fixtures above (pasted as CTEs into oracle SQL).
FIXTURE_SQL = {
    "fx_registry": """SELECT o_orderkey AS seq,
  CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN '123'
       ELSE concat('3-', cast(2000000000 + o_custkey AS VARCHAR)) END AS taxpayer_number,
  c_name AS taxpayer_name, n_name AS taxpayer_city, 'TX' AS taxpayer_state,
  lpad(cast(o_orderkey % 99999 AS VARCHAR), 5, '0') AS taxpayer_zip,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat(cast(o_custkey AS VARCHAR), ' Commerce St') END AS taxpayer_address,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(o_orderkey AS VARCHAR) END AS outlet_number,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS outlet_name,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE n_name END AS outlet_city,
  CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE cast(cast(o_orderdate AS DATE) AS VARCHAR) END AS outlet_permit_issue_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "fx_account": """SELECT c_custkey AS seq,
  concat(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '38' ELSE '32' END, lpad(cast(c_custkey AS VARCHAR), 9, '0')) AS taxpayer_id,
  CASE WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status, c_mktsegment AS entity_type,
  c_acctbal AS balance,
  CASE WHEN c_custkey % 4 = 0 THEN concat(c_name, ' Holdings Group') WHEN c_custkey % 4 = 1 THEN '' END AS legal_name,
  CASE WHEN c_custkey % 5 = 0 THEN concat(cast(c_custkey AS VARCHAR), ' Market St') END AS address,
  concat('2020-', lpad(cast(c_custkey % 12 + 1 AS VARCHAR), 2, '0'), '-15') AS filing_date
FROM customer
UNION ALL
SELECT 1000000 + s_suppkey, concat('39', lpad(cast(s_suppkey AS VARCHAR), 9, '0')), 'ACTIVE', 'SUPPLIER',
  s_acctbal, s_name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM supplier""",
    "fx_places": """SELECT c_custkey AS seq, concat('32', lpad(cast(c_custkey AS VARCHAR), 9, '0')) AS taxpayer_id,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE concat('P', cast(c_custkey AS VARCHAR)) END AS place_id,
  CASE WHEN c_custkey % 11 = 0 THEN 'no_place_id' WHEN c_custkey % 5 = 0 THEN 'error' ELSE 'success' END AS details_status,
  c_name AS name, cast(c_custkey % 50 AS DOUBLE) / 10 AS rating,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('https://example.com/', cast(c_custkey AS VARCHAR)) END AS website,
  c_custkey % 500 AS user_ratings_total
FROM customer""",
    "fx_contacts": """SELECT c_custkey AS seq,
  CASE WHEN c_custkey % 10 = 0 THEN '12-34' WHEN c_custkey % 10 = 1 THEN ''
       ELSE concat('32', lpad(cast(c_custkey % 500 AS VARCHAR), 9, '0')) END AS taxpayer_id,
  c_name AS business_name,
  CASE c_custkey % 4 WHEN 0 THEN '78701' WHEN 1 THEN '78701-1234' WHEN 2 THEN ' 7870' ELSE '' END AS zip,
  CASE c_custkey % 3 WHEN 0 THEN concat(lower(replace(c_name, '#', '.')), '@example.com') WHEN 1 THEN 'bad@' ELSE NULL END AS email,
  CASE c_custkey % 3 WHEN 0 THEN concat('512-555-', lpad(cast(c_custkey % 10000 AS VARCHAR), 4, '0')) WHEN 1 THEN '5551234' ELSE '' END AS phone
FROM customer""",
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named fixtures as CTEs (for DuckDB)."""
    ctes = ",\n".join(f"{n} AS (\n{FIXTURE_SQL[n]}\n)" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def fx_status(cat: Catalog) -> DataFrame:
    """Per-taxpayer status records (several per key, many keys without any): every order is
    a status filing, those that are not urgent under keys without a taxpayer."""
    series = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("32")).otherwise(F.lit("37"))
    return cat.orders.select(
        F.col("o_orderkey").alias("seq"),
        F.concat(series, F.lpad(_s(F.col("o_custkey")), 9, "0")).alias("taxpayer_id"),
        F.col("o_orderstatus").alias("right_to_transact"),
        _s(F.year("o_orderdate")).alias("report_year"),
    )


FIXTURES["fx_status"] = fx_status
FIXTURE_SQL["fx_status"] = """SELECT o_orderkey AS seq,
  concat(CASE WHEN o_orderpriority = '1-URGENT' THEN '32' ELSE '37' END,
         lpad(cast(o_custkey AS VARCHAR), 9, '0')) AS taxpayer_id,
  o_orderstatus AS right_to_transact, cast(year(o_orderdate) AS VARCHAR) AS report_year
FROM orders"""
