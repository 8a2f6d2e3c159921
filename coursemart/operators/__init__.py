from coursemart.operators.batches import batch_sizes, volume_batches
from coursemart.operators.counts import conditional_counts, count_matches_outer, count_pairs_by_key
from coursemart.operators.enrich import enrich_left, enrich_per_key, join_distinct, winner_per_key
from coursemart.operators.keys import dedupe_on_key, dense_sequence, keep_min_per_key, latest_per_key, newest_n
from coursemart.operators.rows import (
    anti_join_append,
    common_keys,
    delete_matching,
    delete_where,
    left_join_large,
    missing_keys,
    restrict_to_keys,
    union_sources,
)

__all__ = [
    "anti_join_append",
    "batch_sizes",
    "common_keys",
    "conditional_counts",
    "count_matches_outer",
    "count_pairs_by_key",
    "dedupe_on_key",
    "delete_matching",
    "delete_where",
    "dense_sequence",
    "enrich_left",
    "enrich_per_key",
    "join_distinct",
    "keep_min_per_key",
    "latest_per_key",
    "left_join_large",
    "missing_keys",
    "newest_n",
    "restrict_to_keys",
    "union_sources",
    "volume_batches",
    "winner_per_key",
]
