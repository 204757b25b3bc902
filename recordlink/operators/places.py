"""Map-place matching: search text, match status, detail transform, attach
(J20, A13, A14, C17, C20, E5, D5).

Remote calls are re-aimed as landed response tables joined on their request
(search text or place id); user code that actually fetches runs through
``recordlink.streaming.lookup.lookup_batch``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlink.functions.expr import as_string, first_truthy, qcol, strip, truthy_of
from recordlink.operators.dedup import order_col, pick_per_key
from recordlink.operators.skew import salted_join

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results. The second /
# third candidates of each part are this library's prefixed combined columns.
# ---------------------------------------------------------------------------
QUERY_NAME_FIELDS = ["taxpayer_name", "registry_business_name", "business_name"]
QUERY_ADDRESS_FIELDS = ["location_address", "taxpayer_address", "registry_taxpayer_address"]
QUERY_CITY_FIELDS = ["location_city", "taxpayer_city", "registry_taxpayer_city"]
QUERY_STATE_FIELDS = ["location_state", "taxpayer_state", "registry_taxpayer_state"]
QUERY_ZIP_FIELDS = ["location_zip_code", "taxpayer_zip", "registry_taxpayer_zip"]
DEFAULT_STATE = "TX"

PLACE_FIELDS = [
    "name", "formatted_address", "formatted_phone_number", "international_phone_number",
    "website", "url", "rating", "user_ratings_total", "business_status", "types",
    "opening_hours", "geometry", "vicinity", "price_level", "reviews", "photos", "place_id",
]

PRICE_LEVELS = {
    "PRICE_LEVEL_FREE": 0,
    "PRICE_LEVEL_INEXPENSIVE": 1,
    "PRICE_LEVEL_MODERATE": 2,
    "PRICE_LEVEL_EXPENSIVE": 3,
    "PRICE_LEVEL_VERY_EXPENSIVE": 4,
}

# Response field -> output field for the plain (renamed) fields.
PLACE_RENAMES = [
    ("formattedAddress", "formatted_address"),
    ("nationalPhoneNumber", "formatted_phone_number"),
    ("internationalPhoneNumber", "international_phone_number"),
    ("websiteUri", "website"),
    ("googleMapsUri", "url"),
    ("rating", "rating"),
    ("userRatingCount", "user_ratings_total"),
    ("businessStatus", "business_status"),
    ("types", "types"),
    ("regularOpeningHours", "opening_hours"),
]


def search_query(df: DataFrame) -> "F.Column":
    """Search text: name, address, city, state (default TX), zip - the first
    truthy value of each part's candidates - joined by single spaces (J20)."""
    state = first_truthy(df, QUERY_STATE_FIELDS)
    parts = [first_truthy(df, QUERY_NAME_FIELDS), first_truthy(df, QUERY_ADDRESS_FIELDS),
             first_truthy(df, QUERY_CITY_FIELDS),
             F.coalesce(state, F.lit(DEFAULT_STATE)), first_truthy(df, QUERY_ZIP_FIELDS)]
    return F.concat_ws(" ", *parts)


def record_key(df: DataFrame, names: Sequence[str] = ("taxpayer_number", "taxpayer_id")):
    """``taxpayer_number or taxpayer_id`` as text."""
    return first_truthy(df, names)


def match_places(records: DataFrame, responses: DataFrame, query_col: str = "search_query",
                 hits_col: str = "places", order_by="seq") -> DataFrame:
    """Place id per record from landed search responses.

    ``responses`` holds ``search_query`` and ``places`` (array of structs with
    ``id``), the last response per query wins. Status: ``found`` (non-empty hit
    list; ``place_id`` is the first hit's id), ``not_found`` (empty hit list),
    ``error`` (no response, or a query that is blank once stripped).
    """
    r = records.withColumn("search_query", search_query(records)).withColumn(
        "_rl_tid", record_key(records))
    resp = pick_per_key(responses, qcol(query_col), order_col(order_by), keep_nulls=False,
                        pick="max", key_out="_rl_rq")
    j = salted_join(r, resp.select(F.col("_rl_rq").alias("search_query"),
                                   F.col(hits_col).alias("_rl_hits"), F.lit(True).alias("_rl_q")),
                    "search_query", "left")
    first_id = F.get(F.col("_rl_hits"), 0)["id"]
    blank = strip(F.col("search_query")) == ""
    status = (F.when(blank | F.col("_rl_q").isNull(), F.lit("error"))
              .when(F.coalesce(F.size("_rl_hits"), F.lit(0)) > 0, F.lit("found"))
              .otherwise(F.lit("not_found")))
    return j.select(F.col("_rl_tid").alias("taxpayer_id"), "search_query",
                    F.when(~blank, first_id).alias("place_id"), status.alias("match_status"))


def transform_place(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Place response columns -> output names (C17): ``displayName.text`` ->
    ``name``, ``location`` -> ``geometry.location{lat,lng}``, ``priceLevel`` enum ->
    0..4 (unknown -> NULL); only fields present in the response schema appear."""
    cols = set(df.columns)
    sel = [qcol(c) for c in keep]
    if "displayName" in cols:
        sel.append(F.coalesce(F.col("displayName.text"), F.lit("")).alias("name"))
    for src, dst in PLACE_RENAMES:
        if src in cols:
            sel.append(qcol(src).alias(dst))
    if "location" in cols:
        sel.append(F.struct(F.struct(F.col("location.latitude").alias("lat"),
                                     F.col("location.longitude").alias("lng")).alias("location"))
                   .alias("geometry"))
    if "priceLevel" in cols:
        m = F.create_map(*[x for k, v in PRICE_LEVELS.items() for x in (F.lit(k), F.lit(v))])
        sel.append(F.try_element_at(m, F.col("priceLevel")).alias("price_level"))
    for src in ("reviews", "photos"):
        if src in cols:
            sel.append(qcol(src))
    return df.select(*sel)


def place_details(requests: DataFrame, responses: DataFrame, order_by="seq",
                  id_col: str = "place_id") -> DataFrame:
    """Details per requested place id from landed responses (A14); the last response per id wins.

    Status ``success`` (a response exists), ``error`` (none), ``no_place_id``
    (blank id). Response columns are transformed with ``transform_place``.
    """
    t = transform_place(responses, keep=[id_col, *[c for c in [order_by] if c in responses.columns]])
    t = pick_per_key(t, qcol(id_col), order_col(order_by), keep_nulls=False, pick="max",
                     key_out="_rl_pid")
    t = t.drop(id_col, *[c for c in [order_by] if c in t.columns])
    req = requests.withColumn("_rl_has", truthy_of(requests, id_col)).withColumn(
        "_rl_pid", qcol(id_col))
    j = salted_join(req, t.withColumn("_rl_found", F.lit(True)), "_rl_pid", "left")
    status = (F.when(~F.col("_rl_has"), F.lit("no_place_id"))
              .when(F.col("_rl_found").isNotNull(), F.lit("success")).otherwise(F.lit("error")))
    return j.withColumn("details_status", status).drop("_rl_has", "_rl_pid", "_rl_found")


def attach_places(base: DataFrame, places: DataFrame, order_by="seq",
                  fields: Sequence[str] = PLACE_FIELDS, prefix_: str = "google_",
                  flag: str = "google_places_enriched",
                  base_key: Sequence[str] = ("taxpayer_number", "taxpayer_id"),
                  place_key: str = "taxpayer_id", status_col: str = "details_status") -> DataFrame:
    """Left-join successful place details onto records (E5 + C20).

    Places with ``status_col == 'success'`` and a truthy key are indexed by
    ``str(key)``, the last per key wins. Records are keyed by
    ``taxpayer_number or taxpayer_id``. Matched records get ``{prefix_}{field}``
    for each place field present; every record gets ``flag``.
    """
    ok = places.where((F.col(status_col) == "success") & truthy_of(places, place_key))
    fs = [f for f in fields if f in places.columns]
    k = as_string(qcol(place_key), places.schema[place_key].dataType)
    p = pick_per_key(ok, k, order_col(order_by), keep_nulls=False, pick="max", key_out="_rl_pk")
    p = p.select(F.col("_rl_pk").alias("_rl_bk"), F.lit(True).alias("_rl_pk"),
                 *[qcol(f).alias(f"{prefix_}{f}") for f in fs])
    b = base.withColumn("_rl_bk", first_truthy(base, base_key))
    j = salted_join(b, p, "_rl_bk", "left")
    return j.withColumn(flag, F.col("_rl_pk").isNotNull()).drop("_rl_bk", "_rl_pk")
