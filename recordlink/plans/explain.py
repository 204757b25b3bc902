"""Print the physical plans of registered queries (as planned, before AQE's
runtime changes such as coalescing or broadcast conversion), keeping only the
plan-shape lines: scans, filters, exchanges, joins, aggregates, windows.

    python -m recordlink.plans.explain [sf_dir] [query ...]
"""

from __future__ import annotations

import re
import sys

DEFAULT = ["combine_full", "dedup_key", "dedup_merge", "duplicate_groups", "outlets_merged",
           "quality_report", "new_records", "topn_per_group"]

_KEEP = re.compile(r"(Exchange|Join|Aggregate|Window|Scan|BroadcastExchange|ShuffleQueryStage|"
                   r"BroadcastQueryStage|AQEShuffleRead|Union|Expand|Sort \[|Generate|"
                   r"TakeOrdered|CollectLimit|Filter)")


def summarize(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        if "== Initial Plan ==" in line:
            break
        if _KEEP.search(line):
            line = re.sub(r"#\d+L?", "", line)
            out.append(line[:width])
    return "\n".join(out)


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    names = argv[2:] or DEFAULT
    from recordlink.session import get_session
    spark = get_session("local[8]", 32)
    spark.sparkContext.setLogLevel("ERROR")
    from recordlink.plans.queries import QUERIES
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        print(f"### {n}\n\n```\n{summarize(df._jdf.queryExecution().executedPlan().toString())}\n```\n")


if __name__ == "__main__":
    main(sys.argv)


def stage_times(event_log_dir: str, top: int = 10) -> list:
    """Slowest stages from a Spark event log folder (``spark.eventLog.dir``):
    ``(stage name, tasks, milliseconds)``. Reads plain or zstd-compressed logs."""
    import glob
    import json
    import os
    out = []
    for f in glob.glob(os.path.join(event_log_dir, "**", "events_*"), recursive=True) + \
            glob.glob(os.path.join(event_log_dir, "local-*")):
        with open(f, "rb") as fh:
            raw = fh.read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(__import__("io").BytesIO(raw)).read()
        for line in raw.decode("utf-8", "ignore").splitlines():
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                out.append((si["Stage Name"], si["Number of Tasks"],
                            si.get("Completion Time", 0) - si.get("Submission Time", 0)))
    return sorted(out, key=lambda x: -x[2])[:top]
