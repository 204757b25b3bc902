"""Scale audit of every registered query's physical plan (sf0.001).

No Cartesian products or nested-loop joins, no arrays collected per group, and
windows only where they are bounded or preceded by a per-task limit:
top-N per group (WindowGroupLimit), shares over already-aggregated rows, and
running offsets over one row per partition.
"""

import re

import pytest

from recordlink.plans.queries import QUERIES
from tests.conftest import SF_SMALL

WINDOW_OK = {
    "topn_per_group",      # row_number <= n  -> WindowGroupLimit before the shuffle
    "search_many",         # same, per dataset
    "search_names",        # same, per requested name
    "assign_batches",      # offsets over one row per partition
    "validation_errors",   # same
    "search_names_contains",   # row_number <= n per requested name
    "group_medians", "agg_dropna",  # running counts inside (group, range part); offsets over one row per (group, part)
}
SIDE_EFFECT = {"table_manifest", "stream_ingest", "json_roundtrip", "csv_roundtrip",
               "table_fingerprint", "json_lines_as_json", "csv_text_roundtrip", "stream_replay"}


def _plan(df):
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + qe.optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_is_scale_safe(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert len(set(df.columns)) == len(df.columns), f"{name}: duplicate column names"
    if name not in SIDE_EFFECT:
        again = QUERIES[name](spark, SF_SMALL)
        assert again.schema == df.schema, f"{name}: schema differs between builds"
    plan = _plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set"):
        assert bad not in plan, f"{name}: {bad}"
    # one row per (key, order value): the tie-break of first-row flags
    windows = [x for x in plan.splitlines() if re.search(r"\bWindow\b", x) and "_rl_place" not in x]
    if windows and name not in WINDOW_OK:
        pytest.fail(f"{name}: unexpected window\n{plan}")
    if name in ("topn_per_group", "search_many", "search_names", "search_names_contains"):
        assert "WindowGroupLimit" in plan, name
