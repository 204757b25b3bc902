"""DuckDB oracle SQL for the registered queries (same column names as Spark).

Written independently of the Spark code: windows and plain joins instead of the
aggregate-and-join plans used on Spark.
"""

from __future__ import annotations

from recordlink.plans.fixtures import with_fixtures

ORACLE: dict = {}


def ck(x: str) -> str:
    """Cleaned key in DuckDB: digits when there are 9 to 11 of them."""
    d = f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9]', '', 'g')"
    return f"(CASE WHEN length({d}) BETWEEN 9 AND 11 THEN {d} END)"


def sk(x: str) -> str:
    """Stripped key: truthy value, whitespace-trimmed, blank -> NULL."""
    return (f"(CASE WHEN {x} IS NOT NULL AND CAST({x} AS VARCHAR) <> '' THEN "
            f"nullif(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g'), '') END)")


def tr(x: str) -> str:
    """Truthy test for a string column."""
    return f"({x} IS NOT NULL AND {x} <> '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def digits(x: str) -> str:
    return f"regexp_replace(CAST({x} AS VARCHAR), '[^0-9]', '', 'g')"


_COMBINED = """
reg AS (SELECT *, {ck_reg} AS k FROM fx_registry),
reg1 AS (SELECT * FROM reg WHERE k IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1),
acc AS (SELECT *, {ck_acc} AS k FROM fx_account),
acc1 AS (SELECT * FROM acc WHERE k IS NOT NULL
         QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq DESC) = 1),
comb AS (
  SELECT coalesce(r.k, a.k) AS taxpayer_id, r.k IS NOT NULL AS has_registry_data,
    a.k IS NOT NULL AS has_account_data,
    CASE WHEN a.k IS NOT NULL THEN 'account' ELSE 'registry' END AS data_source,
    r.seq AS registry_seq, r.taxpayer_number AS registry_taxpayer_id,
    r.taxpayer_name AS registry_business_name, r.taxpayer_address AS registry_taxpayer_address,
    r.taxpayer_city AS registry_taxpayer_city, r.taxpayer_state AS registry_taxpayer_state,
    r.outlet_number AS registry_outlet_number, r.outlet_name AS registry_outlet_name,
    a.seq AS account_seq, a.status AS account_status, a.entity_type AS account_entity_type,
    a.balance AS account_balance, a.legal_name AS account_business_name,
    a.address AS account_street_address, a.filing_date AS account_registration_date
  FROM reg1 r FULL JOIN acc1 a ON r.k = a.k)
""".format(ck_reg=ck("taxpayer_number"), ck_acc=ck("taxpayer_id"))

ORACLE["combine_full"] = with_fixtures(f"""WITH {_COMBINED}
SELECT taxpayer_id, has_registry_data, has_account_data, data_source, registry_seq,
  registry_taxpayer_id, registry_business_name, registry_outlet_number, registry_outlet_name,
  account_seq, account_status, account_entity_type, account_balance, account_business_name,
  account_registration_date
FROM comb""", "fx_registry", "fx_account")

ORACLE["combine_stats"] = with_fixtures(f"""WITH {_COMBINED}
SELECT count(*) AS total_records,
  count(*) FILTER (WHERE has_registry_data) AS with_registry_data,
  count(*) FILTER (WHERE has_account_data) AS with_account_data,
  count(*) FILTER (WHERE has_registry_data AND has_account_data) AS with_both_sources,
  count(*) FILTER (WHERE has_registry_data AND NOT has_account_data) AS only_registry,
  count(*) FILTER (WHERE has_account_data AND NOT has_registry_data) AS only_account,
  round(CAST(count(*) FILTER (WHERE has_registry_data) AS DOUBLE) / count(*) * 100.0, 6) AS coverage_registry,
  round(CAST(count(*) FILTER (WHERE has_account_data) AS DOUBLE) / count(*) * 100.0, 6) AS coverage_account,
  round(CAST(count(*) FILTER (WHERE has_registry_data AND has_account_data) AS DOUBLE) / count(*) * 100.0, 6) AS coverage_both
FROM comb""", "fx_registry", "fx_account")


def _w(sql: str, *fx: str) -> str:
    return with_fixtures(sql, *fx)


RF = ("fx_registry", "fx_account")

ORACLE["combine_resolved"] = _w(f"""WITH {_COMBINED}
SELECT taxpayer_id,
  CASE WHEN {tr('registry_business_name')} AND {tr('account_business_name')} THEN
         CASE WHEN length(account_business_name) > length(registry_business_name)
              THEN account_business_name ELSE registry_business_name END
       WHEN {tr('registry_business_name')} THEN registry_business_name
       WHEN {tr('account_business_name')} THEN account_business_name END AS resolved_business_name,
  CASE WHEN {tr('account_street_address')} THEN account_street_address
       WHEN {tr('registry_taxpayer_address')} THEN registry_taxpayer_address END AS resolved_address,
  CASE WHEN {tr('account_street_address')} THEN 'account'
       WHEN {tr('registry_taxpayer_address')} THEN 'registry' END AS resolved_address_source,
  CASE WHEN has_account_data THEN account_registration_date END AS resolved_registration_date
FROM comb""", *RF)

ORACLE["combine_mapped"] = _w(f"""WITH {_COMBINED}
SELECT taxpayer_id, registry_taxpayer_city AS registry_city, registry_taxpayer_state AS registry_state,
  account_status FROM comb""", *RF)

ORACLE["enrich_left"] = _w("""
SELECT a.seq, a.taxpayer_id, p.place_id AS enriched_place_id,
  p.details_status AS enriched_details_status, p.name AS enriched_name, p.rating AS enriched_rating
FROM fx_account a LEFT JOIN (SELECT * FROM fx_places
  QUALIFY row_number() OVER (PARTITION BY taxpayer_id ORDER BY seq DESC) = 1) p
  ON CAST(a.taxpayer_id AS VARCHAR) = CAST(p.taxpayer_id AS VARCHAR)""", "fx_account", "fx_places")

_STATUS = """st AS (SELECT taxpayer_id, count(*) AS n,
    first(right_to_transact ORDER BY seq) AS rtt, first(report_year ORDER BY seq) AS ry
  FROM fx_status GROUP BY taxpayer_id)"""

ORACLE["account_info"] = _w(f"""WITH ids AS (SELECT DISTINCT {ck('taxpayer_number')} AS taxpayer_id FROM fx_registry
  WHERE {ck('taxpayer_number')} IS NOT NULL),
{_STATUS}
SELECT i.taxpayer_id, a.taxpayer_id IS NOT NULL AS has_details, coalesce(st.n, 0) > 0 AS has_ftas,
  coalesce(st.n, 0) AS ftas_count, a.status AS detail_status, a.entity_type AS detail_entity_type,
  a.balance AS detail_balance, st.rtt AS ftas_right_to_transact, st.ry AS ftas_report_year
FROM ids i LEFT JOIN fx_account a ON i.taxpayer_id = a.taxpayer_id
LEFT JOIN st ON i.taxpayer_id = st.taxpayer_id""", "fx_registry", "fx_account", "fx_status")

ORACLE["account_enrich"] = _w(f"""WITH ids AS (SELECT DISTINCT {sk('taxpayer_id')} AS taxpayer_id FROM fx_contacts
  WHERE {sk('taxpayer_id')} IS NOT NULL),
{_STATUS},
acc AS (SELECT i.taxpayer_id, a.taxpayer_id IS NOT NULL AS hd, a.status, a.entity_type,
    coalesce(st.n, 0) > 0 AS hf, coalesce(st.n, 0) AS fc
  FROM ids i LEFT JOIN fx_account a ON i.taxpayer_id = a.taxpayer_id
  LEFT JOIN st ON i.taxpayer_id = st.taxpayer_id)
SELECT c.seq, c.taxpayer_id, CASE WHEN acc.hd THEN acc.status END AS account_status,
  CASE WHEN acc.hd THEN acc.entity_type END AS account_entity_type,
  acc.hf AS account_has_ftas, acc.fc AS account_ftas_count
FROM fx_contacts c LEFT JOIN acc ON {strip('c.taxpayer_id')} = acc.taxpayer_id""",
                              "fx_contacts", "fx_account", "fx_status")

ORACLE["places_attach"] = _w(f"""WITH p AS (SELECT * FROM fx_places
  WHERE details_status = 'success' AND {tr('taxpayer_id')}
  QUALIFY row_number() OVER (PARTITION BY taxpayer_id ORDER BY seq DESC) = 1)
SELECT a.seq, a.taxpayer_id, p.name AS google_name, p.rating AS google_rating,
  p.website AS google_website, p.user_ratings_total AS google_user_ratings_total,
  p.place_id AS google_place_id, p.taxpayer_id IS NOT NULL AS google_places_enriched
FROM fx_account a LEFT JOIN p ON a.taxpayer_id = p.taxpayer_id""", "fx_account", "fx_places")

ORACLE["merge_outer_m2m"] = """
SELECT coalesce(o.o_custkey, c.c_custkey) AS custkey, o.o_orderkey, o.o_orderstatus AS status_x,
  o.o_totalprice AS amount_x, c.c_mktsegment AS status_y, c.c_acctbal AS amount_y, c.c_name
FROM orders o FULL JOIN customer c ON o.o_custkey = c.c_custkey"""

_OLD = "outlet_permit_issue_date < '1998-01-01'"
_SPLIT = f"""ex AS (SELECT * FROM fx_registry WHERE {_OLD}),
b AS (SELECT *, {ck('taxpayer_number')} AS k FROM fx_registry
  WHERE NOT ({_OLD}) OR outlet_permit_issue_date IS NULL)"""

ORACLE["new_records"] = _w(f"""WITH {_SPLIT},
exk AS (SELECT DISTINCT {ck('taxpayer_number')} AS k FROM ex),
f AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM exk WHERE exk.k = b.k))
SELECT seq, taxpayer_number, k AS taxpayer_id FROM f WHERE k IS NULL
UNION ALL
SELECT seq, taxpayer_number, k AS taxpayer_id FROM f WHERE k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1""", "fx_registry")

ORACLE["incremental_ids"] = _w(f"""WITH {_SPLIT}
SELECT seq, taxpayer_number FROM b WHERE {tr('taxpayer_number')}
  AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.taxpayer_number = b.taxpayer_number)""", "fx_registry")

_REQ = f"""req AS (SELECT DISTINCT {ck('taxpayer_number')} AS taxpayer_id FROM fx_registry
  WHERE {ck('taxpayer_number')} IS NOT NULL)"""

ORACLE["cache_split"] = _w(f"""WITH {_REQ},
hits AS (SELECT DISTINCT taxpayer_id FROM fx_places WHERE details_status IN ('success', 'found'))
SELECT r.taxpayer_id, h.taxpayer_id IS NOT NULL AS from_cache
FROM req r LEFT JOIN hits h ON r.taxpayer_id = h.taxpayer_id""", "fx_registry", "fx_places")

ORACLE["remaining_work"] = _w(f"""WITH {_REQ}
SELECT taxpayer_id FROM req r
WHERE NOT EXISTS (SELECT 1 FROM fx_account a WHERE a.taxpayer_id = r.taxpayer_id)""",
                              "fx_registry", "fx_account")

_DK = f"""r AS (SELECT *, {sk('taxpayer_number')} AS dedup_key FROM fx_registry),
fl AS (SELECT *, CASE WHEN dedup_key IS NULL THEN false
    ELSE seq <> min(seq) OVER (PARTITION BY dedup_key) END AS is_duplicate FROM r)"""

ORACLE["dedup_key"] = _w(f"""WITH {_DK}
SELECT seq, taxpayer_number, dedup_key, is_duplicate FROM fl""", "fx_registry")

ORACLE["dedup_stats"] = _w(f"""WITH {_DK},
c AS (SELECT count(*) AS original_count,
  count(*) FILTER (WHERE NOT is_duplicate) AS unique_count,
  count(*) FILTER (WHERE is_duplicate) AS duplicate_count FROM fl)
SELECT original_count, unique_count, duplicate_count,
  round(CAST(duplicate_count AS DOUBLE) / original_count * 100.0, 6) AS deduplication_rate,
  round(CAST(original_count - unique_count AS DOUBLE) / original_count * 100.0, 6) AS reduction_percentage
FROM c""", "fx_registry")

ORACLE["dedup_nullkeys_drop"] = _w(f"""WITH {_DK}
SELECT seq, taxpayer_number FROM r WHERE dedup_key IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY seq) = 1""", "fx_registry")

ORACLE["dedup_duplicates"] = _w("""
SELECT seq, taxpayer_id FROM fx_contacts
  QUALIFY row_number() OVER (PARTITION BY taxpayer_id ORDER BY seq) > 1""", "fx_contacts")

ORACLE["dedup_exact"] = """
SELECT doc_id AS seq, lang,
  row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) > 1 AS is_duplicate
FROM documents"""

ORACLE["dedup_hash"] = """
SELECT doc_id AS seq, n_chars FROM documents
  QUALIFY row_number() OVER (PARTITION BY text, n_chars ORDER BY doc_id) = 1"""

ORACLE["dedup_fuzzy"] = _w(f"""WITH c AS (SELECT *, list_filter([
    CASE WHEN {tr('taxpayer_id')} THEN lower({strip('taxpayer_id')}) END,
    CASE WHEN {tr('business_name')} THEN lower({strip('business_name')}) END],
    lambda x: x IS NOT NULL) AS parts FROM fx_contacts),
k AS (SELECT *, CASE WHEN len(parts) > 0 THEN array_to_string(list_sort(parts), '|') END AS fuzzy_key
  FROM c)
SELECT seq, fuzzy_key, CASE WHEN fuzzy_key IS NULL THEN false
  ELSE seq <> min(seq) OVER (PARTITION BY fuzzy_key) END AS is_duplicate FROM k""", "fx_contacts")

_MERGE_COLS = ["taxpayer_number", "taxpayer_name", "taxpayer_address", "outlet_number", "outlet_name",
               "outlet_city", "outlet_permit_issue_date"]


def _merge_sql(c: str) -> str:
    return (f"coalesce(arg_min({c}, row(-length({c}), seq)) FILTER (WHERE {tr(c)}), "
            f"first({c} ORDER BY seq DESC)) AS {c}")


ORACLE["dedup_merge"] = _w(f"""WITH r AS (SELECT *, {sk('taxpayer_number')} AS k FROM fx_registry)
SELECT min(seq) AS seq, {', '.join(_merge_sql(c) for c in _MERGE_COLS)},
  CASE WHEN count(*) > 1 THEN count(*) END AS _merged_from_count
FROM r WHERE k IS NOT NULL GROUP BY k
UNION ALL
SELECT seq, {', '.join(_MERGE_COLS)}, CAST(NULL AS BIGINT) FROM r WHERE k IS NULL""", "fx_registry")

_REG_COLS = ["taxpayer_number", "taxpayer_name", "taxpayer_city", "taxpayer_state", "taxpayer_zip",
             "taxpayer_address", "outlet_number", "outlet_name", "outlet_city",
             "outlet_permit_issue_date"]
_SCORE = " + ".join(f"(CASE WHEN {tr(c)} THEN 1 ELSE 0 END) + "
                    f"(CASE WHEN {tr(c)} AND length({c}) > 10 THEN 1 ELSE 0 END)" for c in _REG_COLS)

ORACLE["dedup_best"] = _w(f"""WITH r AS (SELECT *, {sk('taxpayer_number')} AS k,
    {_SCORE} AS completeness_score FROM fx_registry)
SELECT seq, taxpayer_number, completeness_score FROM r WHERE k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY completeness_score DESC, seq) = 1
UNION ALL
SELECT seq, taxpayer_number, completeness_score FROM r WHERE k IS NULL""", "fx_registry")

ORACLE["duplicate_groups"] = _w(f"""WITH r AS (SELECT {sk('taxpayer_number')} AS group_key, seq
  FROM fx_registry),
g AS (SELECT group_key, seq, count(*) OVER (PARTITION BY group_key) AS group_size FROM r
  WHERE group_key IS NOT NULL)
SELECT group_key, seq, group_size FROM g WHERE group_size > 1""", "fx_registry")

_OF = ["outlet_number", "outlet_name", "outlet_city", "outlet_permit_issue_date"]
_HAS_OUT = " OR ".join(tr(f) for f in _OF)
_OUTLET_BASE = f"""r AS (SELECT *, {sk('taxpayer_number')} AS k FROM fx_registry),
base AS (SELECT * FROM r WHERE k IS NULL
  UNION ALL SELECT * FROM r WHERE k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1),
outl AS (SELECT k, seq, {', '.join(f'CASE WHEN {tr(f)} THEN {f} END AS {f}' for f in _OF)}
  FROM r WHERE k IS NOT NULL AND ({_HAS_OUT}))"""


def _outlet_select(count_expr: str) -> str:
    fields = ", ".join(f"CASE WHEN dox AND o_{f} IS NOT NULL THEN o_{f} ELSE {f} END AS {f}" for f in _OF)
    return f"SELECT seq, taxpayer_number, {fields}, {count_expr} AS outlet_count, dox AS outlets_attached FROM j"


ORACLE["outlets_first"] = _w(f"""WITH {_OUTLET_BASE},
fo AS (SELECT k, count(*) AS n, {', '.join(f'first({f} ORDER BY seq) AS o_{f}' for f in _OF)}
  FROM outl GROUP BY k),
j AS (SELECT b.*, fo.n, {', '.join(f'fo.o_{f}' for f in _OF)},
  (fo.k IS NOT NULL AND NOT ({' OR '.join(tr('b.' + f) for f in _OF)})) AS dox
  FROM base b LEFT JOIN fo ON b.k = fo.k)
{_outlet_select('CASE WHEN dox THEN n END')}""", "fx_registry")

_OSCORE = " + ".join(f"(CASE WHEN {f} IS NOT NULL THEN 1 ELSE 0 END)" for f in _OF)

ORACLE["outlets_merged"] = _w(f"""WITH {_OUTLET_BASE},
os AS (SELECT *, {_OSCORE} AS score FROM outl),
mo AS (SELECT k, count(*) AS n,
  {', '.join(f'arg_min({f}, row(-score, seq)) FILTER (WHERE {f} IS NOT NULL) AS o_{f}' for f in _OF)}
  FROM os GROUP BY k),
j AS (SELECT b.*, mo.n, {', '.join(f'mo.o_{f}' for f in _OF)}, mo.k IS NOT NULL AS dox
  FROM base b LEFT JOIN mo ON b.k = mo.k)
{_outlet_select('CASE WHEN dox AND n > 1 THEN n END')}""", "fx_registry")

ORACLE["outlet_stats"] = _w(f"""WITH {_OUTLET_BASE},
fo AS (SELECT k FROM outl GROUP BY k),
j AS (SELECT (fo.k IS NOT NULL AND NOT ({' OR '.join(tr('b.' + f) for f in _OF)})) AS dox
  FROM base b LEFT JOIN fo ON b.k = fo.k),
rs AS (SELECT k, ({_HAS_OUT}) AS ho FROM r)
SELECT 'total_source_records' AS metric, count(*) AS value FROM rs
UNION ALL SELECT 'unique_taxpayers', count(DISTINCT k) FROM rs
UNION ALL SELECT 'taxpayers_with_outlets', count(DISTINCT k) FILTER (WHERE ho) FROM rs
UNION ALL SELECT 'total_outlets_found', count(*) FILTER (WHERE k IS NOT NULL AND ho) FROM rs
UNION ALL SELECT 'records_enriched', count(*) FILTER (WHERE dox) FROM j
UNION ALL SELECT 'records_unchanged', count(*) FILTER (WHERE NOT dox) FROM j""", "fx_registry")


def _phone_fmt(x: str) -> str:
    d = digits(x)
    return (f"CASE WHEN length({d}) = 10 THEN '(' || substr({d}, 1, 3) || ') ' || substr({d}, 4, 3)"
            f" || '-' || substr({d}, 7, 4) ELSE {d} END")


ORACLE["clean_contacts"] = _w(f"""
SELECT seq,
  nullif({strip(f"CASE WHEN {tr('taxpayer_id')} THEN {digits('taxpayer_id')} ELSE taxpayer_id END")}, '') AS taxpayer_id,
  nullif({strip('business_name')}, '') AS business_name,
  nullif({strip(f"CASE WHEN {tr('zip')} THEN substr({digits('zip')}, 1, 5) ELSE zip END")}, '') AS zip,
  nullif({strip('email')}, '') AS email,
  nullif({strip(f"CASE WHEN {tr('phone')} THEN {_phone_fmt('phone')} ELSE phone END")}, '') AS phone
FROM fx_contacts""", "fx_contacts")

_VALID_KEY = f"({tr('taxpayer_id')} AND length({digits('taxpayer_id')}) BETWEEN 9 AND 11)"
_VALID_ZIP = f"regexp_matches(replace({strip('zip')}, '-', ''), '^([0-9]{{5}}|[0-9]{{9}})$')"
_VALID_EMAIL = "regexp_matches(email, '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$')"


def _msgs(required=()) -> list:
    m = [f"CASE WHEN NOT {tr(f)} THEN 'Missing required field: {f}' END" for f in required]
    m.append(f"CASE WHEN NOT {_VALID_KEY} THEN 'Invalid taxpayer ID format' END")
    m.append(f"CASE WHEN {tr('zip')} AND NOT {_VALID_ZIP} THEN 'Invalid ZIP code: ' || zip END")
    m.append(f"CASE WHEN {tr('email')} AND NOT {_VALID_EMAIL} THEN 'Invalid email: ' || email END")
    return m


def _validated(required=()) -> str:
    m = _msgs(required)
    return (f"v AS (SELECT *, concat_ws('; ', {', '.join(m)}) AS error_text, "
            f"({' AND '.join(f'({x}) IS NULL' for x in m)}) AS is_valid FROM fx_contacts)")


_REQUIRED = ("business_name", "phone")

ORACLE["validate_contacts"] = _w(f"""WITH {_validated(_REQUIRED)}
SELECT seq, error_text, is_valid FROM v""", "fx_contacts")

ORACLE["validation_errors"] = _w(f"""WITH {_validated(_REQUIRED)},
vi AS (SELECT *, row_number() OVER (ORDER BY seq) - 1 AS record_index FROM v)
SELECT seq, record_index, error_text FROM vi WHERE NOT is_valid ORDER BY seq LIMIT 100""",
                                 "fx_contacts")

ORACLE["validation_summary"] = _w(f"""WITH {_validated(_REQUIRED)}
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_valid) AS valid_records,
  count(*) FILTER (WHERE NOT is_valid) AS invalid_records,
  round(CAST(count(*) FILTER (WHERE is_valid) AS DOUBLE) / count(*) * 100.0, 6) AS validation_rate
FROM v""", "fx_contacts")

ORACLE["quality_report"] = _w(f"""WITH {_validated()},
a AS (SELECT count(*) AS total_records,
  count(*) - count(DISTINCT taxpayer_id) - max(CASE WHEN taxpayer_id IS NULL THEN 1 ELSE 0 END) AS duplicate_count,
  count(*) FILTER (WHERE is_valid) AS valid_records, count(*) FILTER (WHERE NOT is_valid) AS invalid_records
  FROM v)
SELECT total_records, duplicate_count,
  round(CAST(duplicate_count AS DOUBLE) / total_records * 100.0, 6) AS duplicate_rate,
  valid_records, invalid_records,
  round(CAST(valid_records AS DOUBLE) / total_records * 100.0, 6) AS validation_rate FROM a""",
                              "fx_contacts")


def _completeness_sql(table: str, cols: list) -> str:
    parts = [f"SELECT '{c}' AS field, {i} AS pos, count(*) FILTER (WHERE {tr(c)}) AS filled, "
             f"round(CAST(count(*) FILTER (WHERE {tr(c)}) AS DOUBLE) / count(*) * 100.0, 6) AS completeness "
             f"FROM {table}" for i, c in enumerate(cols)]
    return "\nUNION ALL\n".join(parts)


ORACLE["completeness"] = _w(_completeness_sql(
    "fx_contacts", ["taxpayer_id", "business_name", "zip", "email", "phone"]), "fx_contacts")

ORACLE["completeness_top"] = _w(f"""WITH c AS ({_completeness_sql('fx_registry', _REG_COLS)})
SELECT field, pos, completeness FROM c ORDER BY completeness DESC, pos LIMIT 5""", "fx_registry")

ORACLE["normalize_collide"] = _w(f"""WITH c AS (SELECT *,
  CASE WHEN seq % 2 = 0 THEN '' ELSE concat(zip, 'X') END AS zipcode,
  CASE WHEN seq % 5 = 0 THEN NULL ELSE '555-0100' END AS telephone FROM fx_contacts)
SELECT seq, taxpayer_id, business_name,
  CASE WHEN {tr('zipcode')} THEN zipcode WHEN {tr('zip')} THEN zip ELSE zipcode END AS zip_code,
  email,
  CASE WHEN {tr('telephone')} THEN telephone WHEN {tr('phone')} THEN phone ELSE telephone END AS phone
FROM c""", "fx_contacts")

ORACLE["standardize_fields"] = _w("""
SELECT seq, taxpayer_number AS taxpayer_id, taxpayer_name AS business_name, taxpayer_zip AS zip,
  taxpayer_city FROM fx_registry""", "fx_registry")

ORACLE["search_contains"] = """
SELECT c_custkey AS seq, c_name FROM customer WHERE contains(upper(c_name), 'R#00000001')"""

ORACLE["search_many"] = """WITH u AS (
  SELECT 'customer' AS dataset_id, c_custkey AS seq, c_name AS name FROM customer
    WHERE contains(upper(c_name), 'ER#0000000')
  UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier
    WHERE contains(upper(s_name), 'ER#0000000')
  UNION ALL SELECT 'part', p_partkey, p_name FROM part
    WHERE contains(upper(p_name), 'ER#0000000'))
SELECT dataset_id, seq, name FROM u
  QUALIFY row_number() OVER (PARTITION BY dataset_id ORDER BY seq) <= 100"""

ORACLE["topn_per_group"] = """
SELECT p_partkey, p_brand, p_retailprice,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank
FROM part QUALIFY rank <= 3"""

ORACLE["soql_like"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
WHERE l_quantity > 45 AND l_returnflag = 'R'
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey
LIMIT 50 OFFSET 10"""

_LORD = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ORACLE["agg_dropna"] = f"""WITH li AS (SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag END AS flag,
  * FROM lineitem)
SELECT flag, sum(l_quantity) AS l_quantity_sum, avg(l_quantity) AS l_quantity_mean,
  min(l_quantity) AS l_quantity_min, max(l_quantity) AS l_quantity_max,
  round(stddev_samp(l_quantity), 6) AS l_quantity_std, round(var_samp(l_quantity), 6) AS l_quantity_var,
  median(l_quantity) AS l_quantity_median, count(DISTINCT l_partkey) AS l_partkey,
  first(l_suppkey ORDER BY {_LORD}) AS l_suppkey_first,
  first(l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS l_suppkey_last,
  count(*) AS l_discount
FROM li WHERE flag IS NOT NULL GROUP BY flag"""

ORACLE["key_extract"] = _w(f"""
SELECT DISTINCT {ck('taxpayer_number')} AS taxpayer_id FROM fx_registry
WHERE {ck('taxpayer_number')} IS NOT NULL""", "fx_registry")

ORACLE["status_counts"] = _w("""
SELECT details_status, count(*) AS count,
  round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100.0, 6) AS percentage
FROM fx_places GROUP BY details_status""", "fx_places")

ORACLE["union_schemas"] = """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
  CAST(c_nationkey AS VARCHAR) AS nationkey, 'customer' AS dataset_id FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance,
  CAST(s_nationkey AS VARCHAR) AS nationkey, 'supplier' AS dataset_id FROM supplier"""

ORACLE["assign_batches"] = """
SELECT c_custkey, c_name, (row_number() OVER (ORDER BY c_custkey) - 1) // 100 AS batch FROM customer"""

ORACLE["search_query"] = _w(f"""
SELECT seq, concat_ws(' ', CASE WHEN {tr('taxpayer_name')} THEN taxpayer_name END,
  CASE WHEN {tr('taxpayer_address')} THEN taxpayer_address END,
  CASE WHEN {tr('taxpayer_city')} THEN taxpayer_city END,
  coalesce(CASE WHEN {tr('taxpayer_state')} THEN taxpayer_state END, 'TX'),
  CASE WHEN {tr('taxpayer_zip')} THEN taxpayer_zip END) AS search_query
FROM fx_registry""", "fx_registry")

_PRICE = ("CASE c_custkey % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 "
          "WHEN 4 THEN 4 END")

ORACLE["places_transform"] = f"""
SELECT concat('P', CAST(c_custkey AS VARCHAR)) AS place_id, coalesce(c_name, '') AS name,
  concat(CAST(c_custkey AS VARCHAR), ' Main St') AS formatted_address,
  CAST(c_custkey % 50 AS DOUBLE) / 10 AS rating, CAST(c_custkey % 1000 AS INTEGER) AS user_ratings_total,
  CAST(c_custkey AS DOUBLE) / 1000 AS geometry_location_lat,
  -CAST(c_custkey AS DOUBLE) / 1000 AS geometry_location_lng,
  {_PRICE} AS price_level
FROM customer"""

ORACLE["place_details"] = _w(f"""WITH resp AS (SELECT concat(CASE WHEN c_acctbal >= 0 THEN 'P' ELSE 'Q' END, CAST(c_custkey AS VARCHAR)) AS pid,
    coalesce(c_name, '') AS name, {_PRICE} AS price_level, CAST(c_custkey AS DOUBLE) / 1000 AS lat
  FROM customer)
SELECT p.taxpayer_id, p.place_id,
  CASE WHEN NOT {tr('p.place_id')} THEN 'no_place_id' WHEN r.pid IS NOT NULL THEN 'success'
       ELSE 'error' END AS details_status, r.name, r.price_level, r.lat
FROM fx_places p LEFT JOIN resp r ON p.place_id = r.pid""", "fx_places")

ORACLE["flatten_nested"] = """
SELECT c_custkey AS id, c_name AS info_name, c_mktsegment AS info_segment,
  c_acctbal AS info_balance_amount FROM customer"""


def _extract_sql(pattern: str, numbers: bool = False, table: str = "documents", id_col: str = "doc_id",
                 text_col: str = "text") -> str:
    m = "coalesce(nullif(regexp_replace(match, '^0+', ''), ''), '0')" if numbers else "match"
    return f"""WITH x AS (SELECT {id_col}, regexp_extract_all({text_col}, '{pattern}') AS m FROM {table}),
u AS (SELECT {id_col}, unnest(generate_series(0, len(m) - 1)) AS match_pos, unnest(m) AS match FROM x)
SELECT {id_col}, CAST(match_pos AS INTEGER) AS match_pos, {m} AS match FROM u"""


def _patterns():
    from recordlink.functions.text import EMAIL_FIND_PATTERN, NUMBER_PATTERN, URL_PATTERN
    return EMAIL_FIND_PATTERN, NUMBER_PATTERN, URL_PATTERN


_EP, _NP, _UP = _patterns()
ORACLE["extract_emails"] = _extract_sql(_EP)
ORACLE["extract_numbers"] = _extract_sql(_NP, numbers=True)
ORACLE["extract_urls"] = _extract_sql(
    _UP, table="pages", id_col="page_id",
    text_col="'see ' || url || ' or <' || url || '/a%20b?x=1> but not ftp://' || url || '#end'")

ORACLE["json_bad_first_line"] = """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey NOT IN (SELECT min(o_orderkey) FROM orders GROUP BY o_orderkey % 4)"""

ORACLE["ragged_records"] = """
SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'object' WHEN 1 THEN 'integer' ELSE 'string' END AS kind,
  CASE WHEN o_orderkey % 3 = 2 THEN -1 ELSE o_custkey END AS amount,
  CASE WHEN o_orderkey % 3 = 2 THEN 'x' ELSE 'none' END AS tag FROM orders"""

ORACLE["ragged_paths"] = """
WITH f AS (
  SELECT '$.id' AS path, 'integer' AS kind FROM orders
  UNION ALL SELECT '$.amount', CASE o_orderkey % 3 WHEN 0 THEN 'object' WHEN 1 THEN 'integer' ELSE 'string' END FROM orders
  UNION ALL SELECT '$.amount.value', 'integer' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT '$.amount.unit', 'string' FROM orders WHERE o_orderkey % 3 = 0
  UNION ALL SELECT '$.tags', 'array' FROM orders WHERE o_orderkey % 3 = 2)
SELECT path, count(*) FILTER (kind = 'integer') AS n_integer, count(*) FILTER (kind = 'number') AS n_number,
  count(*) FILTER (kind = 'string') AS n_string, count(*) FILTER (kind = 'boolean') AS n_boolean,
  count(*) FILTER (kind = 'object') AS n_object, count(*) FILTER (kind = 'array') AS n_array,
  count(*) FILTER (kind = 'null') AS n_null FROM f GROUP BY path"""

ORACLE["ragged_shredded"] = """
SELECT o_orderkey AS id_integer, CASE WHEN o_orderkey % 3 = 1 THEN o_custkey END AS amount_integer,
  CASE WHEN o_orderkey % 3 = 2 THEN 'n/a' END AS amount_string,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS amount_value_integer,
  CASE WHEN o_orderkey % 3 = 0 THEN 'USD' END AS amount_unit_string FROM orders"""

ORACLE["json_roundtrip"] = _w("""
SELECT seq, taxpayer_id, status, balance FROM fx_account""", "fx_account")

ORACLE["csv_roundtrip"] = _w("""
SELECT CAST(seq AS VARCHAR) AS seq, nullif(taxpayer_id, '') AS taxpayer_id, nullif(zip, '') AS zip,
  nullif(email, '') AS email, nullif(phone, '') AS phone FROM fx_contacts""", "fx_contacts")

ORACLE["stream_ingest"] = _w(f"""WITH {_SPLIT},
e AS (SELECT *, {ck('taxpayer_number')} AS k FROM ex),
d1 AS (SELECT seq, taxpayer_number, k FROM e WHERE k IS NULL
  UNION ALL SELECT seq, taxpayer_number, k FROM e WHERE k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1),
f AS (SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.k = b.k)),
d2 AS (SELECT seq, taxpayer_number, k FROM f WHERE k IS NULL
  UNION ALL SELECT seq, taxpayer_number, k FROM f WHERE k IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1)
SELECT seq, taxpayer_number, k AS taxpayer_id FROM d1
UNION ALL SELECT seq, taxpayer_number, k AS taxpayer_id FROM d2""", "fx_registry")

ORACLE["lookup_batch"] = _w(f"""WITH {_REQ},
acc AS (SELECT taxpayer_id, first(status) AS status FROM fx_account GROUP BY taxpayer_id)
SELECT r.taxpayer_id,
  CASE WHEN a.taxpayer_id IS NOT NULL THEN a.status
       WHEN right(r.taxpayer_id, 1) IN ('7', '3') THEN NULL
       WHEN CAST(right(r.taxpayer_id, 1) AS INTEGER) % 2 = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
  CASE WHEN a.taxpayer_id IS NULL AND right(r.taxpayer_id, 1) = '7'
       THEN 'ValueError: lookup failed' END AS error,
  a.taxpayer_id IS NOT NULL AS from_cache
FROM req r LEFT JOIN acc a ON r.taxpayer_id = a.taxpayer_id""", "fx_registry", "fx_account")

_SQ = (f"concat_ws(' ', CASE WHEN {tr('taxpayer_name')} THEN taxpayer_name END, "
       f"CASE WHEN {tr('taxpayer_address')} THEN taxpayer_address END, "
       f"CASE WHEN {tr('taxpayer_city')} THEN taxpayer_city END, "
       f"coalesce(CASE WHEN {tr('taxpayer_state')} THEN taxpayer_state END, 'TX'), "
       f"CASE WHEN {tr('taxpayer_zip')} THEN taxpayer_zip END)")
_UREG = f"""r AS (SELECT *, {sk('taxpayer_number')} AS k FROM fx_registry),
u AS (SELECT * FROM r WHERE k IS NULL
  UNION ALL SELECT * FROM r WHERE k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1)"""

ORACLE["places_match"] = _w(f"""WITH {_UREG},
q AS (SELECT *, {_SQ} AS search_query FROM u),
resp AS (SELECT CASE WHEN taxpayer_city = 'GERMANY' THEN concat(search_query, ' (old)') ELSE search_query END AS search_query,
  CASE WHEN outlet_name = '' THEN NULL ELSE concat('P', CAST(seq AS VARCHAR)) END AS first_id,
  outlet_name <> '' AS has_hits, seq FROM q),
resp1 AS (SELECT * FROM resp QUALIFY row_number() OVER (PARTITION BY search_query ORDER BY seq DESC) = 1)
SELECT CASE WHEN {tr('q.taxpayer_number')} THEN q.taxpayer_number END AS taxpayer_id, q.search_query,
  CASE WHEN {strip('q.search_query')} <> '' THEN r.first_id END AS place_id,
  CASE WHEN {strip('q.search_query')} = '' OR r.search_query IS NULL THEN 'error'
       WHEN r.has_hits THEN 'found' ELSE 'not_found' END AS match_status
FROM q LEFT JOIN resp1 r ON q.search_query = r.search_query""", "fx_registry")

ORACLE["id_validation"] = _w(f"""
SELECT seq, taxpayer_id, {_VALID_KEY} AS is_valid, {ck('taxpayer_id')} AS cleaned_id FROM fx_contacts""",
                             "fx_contacts")

ORACLE["smart_merge"] = _w("""
SELECT a.taxpayer_id, p.seq, p.name AS business_name, a.status, p.place_id, a.address AS street_address,
  'seq,taxpayer_id,status,entity_type,balance,legal_name,address,filing_date' AS left_fields,
  'seq,taxpayer_id,place_id,details_status,name,rating,website,user_ratings_total' AS right_fields
FROM fx_account a JOIN fx_places p ON a.taxpayer_id = p.taxpayer_id""", "fx_account", "fx_places")

ORACLE["semantic_fields"] = _w("""
SELECT seq, taxpayer_name AS business_name, taxpayer_number AS taxpayer_id, CAST(NULL AS VARCHAR) AS city
FROM fx_registry""", "fx_registry")

ORACLE["remove_empty"] = _w("""
SELECT seq, nullif(taxpayer_id, '') AS taxpayer_id, nullif(business_name, '') AS business_name,
  nullif(zip, '') AS zip, nullif(email, '') AS email, nullif(phone, '') AS phone FROM fx_contacts""",
                            "fx_contacts")

ORACLE["safe_casts"] = _w("""
SELECT seq, coalesce(TRY_CAST(zip AS BIGINT), 0) AS zip_int, coalesce(TRY_CAST(zip AS DOUBLE), -1.0) AS zip_float,
  greatest(100, least(seq, 1000)) AS seq_clamped FROM fx_contacts""", "fx_contacts")

ORACLE["date_checks"] = _w("""
SELECT seq, coalesce(try_strptime(outlet_permit_issue_date, '%Y-%m-%d') IS NOT NULL, false) AS valid_date,
  coalesce(try_strptime(outlet_permit_issue_date, '%d/%m/%Y') IS NOT NULL, false) AS valid_dmy,
  strftime(CAST(outlet_permit_issue_date AS DATE), '%d/%m/%Y') AS dmy
FROM fx_registry""", "fx_registry")

ORACLE["preview_rows"] = _w("""
SELECT seq, taxpayer_number, taxpayer_name, taxpayer_city, taxpayer_state, taxpayer_zip, taxpayer_address,
  outlet_number FROM fx_registry ORDER BY seq LIMIT 5""", "fx_registry")

ORACLE["dedup_nullkeys_one"] = _w(f"""WITH {_DK}
SELECT seq, taxpayer_number FROM r QUALIFY row_number() OVER (PARTITION BY dedup_key ORDER BY seq) = 1""",
                                  "fx_registry")

ORACLE["processing_summary"] = _w(f"""WITH ids AS (SELECT DISTINCT {ck('taxpayer_number')} AS taxpayer_id
  FROM fx_registry WHERE {ck('taxpayer_number')} IS NOT NULL),
{_STATUS},
failed AS (SELECT DISTINCT concat('3', cast(2000000000 + c_custkey AS VARCHAR)) AS taxpayer_id FROM customer WHERE c_acctbal < 0),
a AS (SELECT i.taxpayer_id, d.taxpayer_id IS NOT NULL AS hd, coalesce(st.n, 0) > 0 AS hf, f.taxpayer_id IS NOT NULL AS bad
  FROM ids i LEFT JOIN fx_account d ON i.taxpayer_id = d.taxpayer_id LEFT JOIN st ON i.taxpayer_id = st.taxpayer_id
  LEFT JOIN failed f ON i.taxpayer_id = f.taxpayer_id)
SELECT count(*) AS total_records, count(*) FILTER (WHERE hd) AS with_details,
  count(*) FILTER (WHERE hf) AS with_ftas, count(*) FILTER (WHERE bad) AS errors,
  round(CAST(count(*) FILTER (WHERE hd) AS DOUBLE) / count(*) * 100.0, 6) AS with_details_pct,
  round(CAST(count(*) FILTER (WHERE hf) AS DOUBLE) / count(*) * 100.0, 6) AS with_ftas_pct,
  round(CAST(count(*) FILTER (WHERE bad) AS DOUBLE) / count(*) * 100.0, 6) AS errors_pct
FROM a""", "fx_registry", "fx_account", "fx_status")

ORACLE["merge_row_counts"] = _w(f"""WITH {_COMBINED}
SELECT 'registry' AS name, count(*) AS rows FROM fx_registry
UNION ALL SELECT 'account', count(*) FROM fx_account
UNION ALL SELECT 'combined', count(*) FROM comb""", *RF)

ORACLE["landed_status"] = _w("""
SELECT taxpayer_id, 0 AS pos, right_to_transact, report_year FROM fx_status""", "fx_status")

ORACLE["arrow_batches"] = """SELECT c_custkey, CAST(length(c_name) AS BIGINT) AS name_len FROM customer"""

ORACLE["search_names"] = _w("""WITH names AS (SELECT DISTINCT lower(n_name) AS name FROM nation JOIN region
    ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'),
j AS (SELECT n.name AS query_name, r.seq, r.taxpayer_city FROM fx_registry r
    JOIN names n ON upper(r.taxpayer_city) = upper(n.name))
SELECT query_name, seq, taxpayer_city FROM j
  QUALIFY row_number() OVER (PARTITION BY query_name ORDER BY seq) <= 10""", "fx_registry")


ORACLE["table_manifest"] = "SELECT TRUE AS all_verified, count(*) > 0 AS any_files FROM customer"

ORACLE["table_fingerprint"] = """SELECT count(*) AS rows, TRUE AS copy_equal, FALSE AS altered_equal FROM customer"""

ORACLE["json_lines_as_json"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"

ORACLE["csv_text_roundtrip"] = """SELECT CAST(doc_id AS VARCHAR) AS doc_id,
  md5(concat('said "', text, '", twice')) AS text_md5 FROM documents"""

ORACLE["dedup_null_order"] = """SELECT o_custkey,
  min(CASE WHEN o_orderkey % 3 <> 0 THEN CAST(floor(o_orderkey / 50) AS BIGINT) END) AS seq
FROM orders GROUP BY o_custkey"""

ORACLE["stream_replay"] = """WITH first AS (SELECT o_custkey, min(o_orderkey) AS seq FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
second AS (SELECT o_custkey, min(o_orderkey) AS seq FROM orders WHERE o_orderkey % 2 = 1
  AND o_custkey NOT IN (SELECT o_custkey FROM first) GROUP BY 1)
SELECT seq, CAST(o_custkey AS VARCHAR) AS taxpayer_id FROM first UNION ALL
SELECT seq, CAST(o_custkey AS VARCHAR) FROM second"""

ORACLE["stream_two_runs"] = ORACLE["stream_replay"]

ORACLE["stream_run_report"] = f"""WITH w AS ({ORACLE["stream_replay"]}),
t AS (SELECT (SELECT count(*) FROM orders) AS n, (SELECT count(*) FROM w) AS kept)
SELECT CAST(2 AS BIGINT) AS batches, n AS completed, kept AS written, n - kept AS skipped, CAST(0 AS BIGINT) AS without_key,
  n AS pending, 50.0::DOUBLE AS percent FROM t"""

ORACLE["search_names_contains"] = """WITH texts AS (SELECT c_custkey AS seq, concat_ws(' ', c_name, c_mktsegment, c_mktsegment || '_100%') AS text FROM customer),
names AS (SELECT lower(substr(n_name, 1, 4)) AS name FROM nation UNION SELECT substr(c_mktsegment, 2, 5) FROM customer
  UNION SELECT '#' || right(c_name, 4) FROM customer UNION SELECT lower(substr(r_name, 2, 2)) FROM region UNION SELECT '_1' FROM region
  UNION SELECT right(c_name, 5) FROM customer)
SELECT name AS query_name, seq FROM texts JOIN names ON contains(upper(text), upper(name)) WHERE length(name) > 0
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY seq) <= 10"""

ORACLE["merge_outer_split"] = """WITH l AS (SELECT CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 400 END AS k, o_orderkey, o_totalprice AS amount_x FROM orders),
r AS (SELECT CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 431 END AS k, c_custkey, c_acctbal AS amount_y FROM customer)
SELECT coalesce(l.k, r.k) AS k, o_orderkey, amount_x, c_custkey, amount_y FROM l FULL JOIN r ON l.k = r.k"""

ORACLE["group_medians"] = """WITH g AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'third' ELSE 's' || CAST(l_suppkey % 97 AS VARCHAR) END AS grp, l_extendedprice FROM lineitem)
SELECT grp, round(median(CAST(l_extendedprice AS DOUBLE)), 6) AS median_price FROM g GROUP BY grp"""

ORACLE["lookup_windowed"] = """SELECT CAST(c_custkey AS VARCHAR) AS taxpayer_id,
  CASE WHEN c_custkey % 10 IN (3, 7) THEN NULL WHEN c_custkey % 2 = 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status,
  CASE WHEN c_custkey % 10 = 7 THEN 'ValueError: lookup failed' END AS error FROM customer"""

ORACLE["lookup_resumed"] = """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS taxpayer_id,
  CASE WHEN o_custkey % 100 = 77 THEN NULL WHEN o_custkey % 10 = 7 THEN 'RETRIED' ELSE 'S' || CAST(o_custkey % 4 AS VARCHAR) END AS status,
  CASE WHEN o_custkey % 100 = 77 THEN 'ValueError: lookup failed again' END AS error,
  CAST(CASE WHEN o_custkey % 10 = 7 THEN 1 ELSE 0 END AS INTEGER) AS attempt FROM orders"""

ORACLE["file_digests"] = "SELECT count(*) >= 0 AS all_equal, count(*) >= 0 AS all_verified FROM orders"

# rows without a key are all kept
ORACLE["dedup_all_files"] = _w("""WITH k AS (
  SELECT 'registry' AS file, nullif(trim(taxpayer_number), '') AS k FROM fx_registry
  UNION ALL SELECT 'account', nullif(trim(taxpayer_id), '') FROM fx_account)
SELECT file, count(*) AS original_count, count(DISTINCT k) + count(*) FILTER (WHERE k IS NULL) AS unique_count,
  count(k) - count(DISTINCT k) AS duplicate_count FROM k GROUP BY file""", "fx_registry", "fx_account")

ORACLE["account_job"] = _w(f"""WITH ids AS (
  SELECT DISTINCT 'registry' AS source, {ck('taxpayer_number')} AS taxpayer_id FROM fx_registry WHERE {ck('taxpayer_number')} IS NOT NULL
  UNION ALL SELECT DISTINCT 'account', {ck('taxpayer_id')} FROM fx_account WHERE {ck('taxpayer_id')} IS NOT NULL),
n AS (SELECT *, CAST(right(taxpayer_id, 3) AS INTEGER) AS n FROM ids)
SELECT source, taxpayer_id, n % 10 NOT IN (3, 7) AS has_details, n % 3 > 0 AS has_ftas, CAST(n % 3 AS BIGINT) AS ftas_count,
  CASE WHEN n % 10 NOT IN (3, 7) THEN 'S' || CAST(n % 4 AS VARCHAR) END AS detail_status,
  CASE n % 3 WHEN 1 THEN '2020' WHEN 2 THEN '2000' END AS ftas_report_year,
  CASE WHEN n % 10 = 7 THEN 'ValueError: lookup failed' END AS error FROM n""", "fx_registry", "fx_account")
