"""recordlink: Spark-native linkage, dedup, enrichment and quality checks for
business-entity records.

Every operator is ``f(DataFrame, ...) -> DataFrame`` (lazy) or a ``Column``
expression; only ``write_*`` / ``run_*`` style functions trigger Spark actions.

    import recordlink as rl
    flagged = rl.dedup(df, "key", order_by="seq")
    merged = rl.merge_duplicates(df, order_by="seq")
    combined = rl.combine(registry, account, resolve=True)
"""

from recordlink.session import checkpoint_dir, get_session  # noqa: F401
from recordlink.functions.expr import (  # noqa: F401
    clean_key, format_phone, format_zip, strip, truthy, valid_email, valid_key, valid_phone,
    valid_zip)
from recordlink.functions.text import extract  # noqa: F401
from recordlink.operators.schema import (  # noqa: F401
    flatten, normalize, prefix, resolve_key, smart_merge, standardize, unflatten)
from recordlink.operators.dedup import (  # noqa: F401
    best_by_completeness, dedup, dedup_stats, detect_duplicates, duplicate_groups, duplicates,
    merge_duplicates, unique)
from recordlink.operators.combine import (  # noqa: F401
    attach_account, cache_split, combine, combine_stats, enrich, incremental_ids, merge_outer,
    new_records, remaining)
from recordlink.operators.outlets import (  # noqa: F401
    attach_merged_outlets, attach_outlets, collect_outlets, outlet_stats)
from recordlink.operators.places import (  # noqa: F401
    attach_places, match_places, place_details, search_query, transform_place)
from recordlink.operators.quality import (  # noqa: F401
    clean, completeness, quality_report, validate, validation_report)
from recordlink.operators.search import query, search, search_many, search_names, top_n  # noqa: F401
from recordlink.operators.aggregate import group_agg, status_counts  # noqa: F401
from recordlink.operators.batches import assign_batches, row_index, union_all  # noqa: F401
from recordlink.operators.skew import salted_join  # noqa: F401
from recordlink.sources.readers import latest, read_auto, read_dir, with_seq  # noqa: F401
from recordlink.sources.sinks import (  # noqa: F401
    fingerprint, verify_manifest, write_all, write_append, write_manifest)
from recordlink.streaming.incremental import stream_ingest  # noqa: F401
from recordlink.streaming.lookup import lookup_batch, map_batches  # noqa: F401

__version__ = "0.1.0"
