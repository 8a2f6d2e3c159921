from coursemart.jobs.history import append_load_log, load_log_entry, load_log_history, load_log_latest
from coursemart.jobs.quality import health_findings, log_errors, shrunken, stale, volumes
from coursemart.jobs.snapshots import (
    SnapshotError,
    asof,
    latest,
    prune,
    read_latest,
    read_snapshots,
    restore,
    retain,
    snapshot,
    snapshot_times,
)
from coursemart.jobs.text import ENGLISH_STOPWORDS, split_attribute_prefix, treebank_tokens, word_frequency

__all__ = [
    "ENGLISH_STOPWORDS",
    "SnapshotError",
    "append_load_log",
    "asof",
    "health_findings",
    "latest",
    "load_log_entry",
    "load_log_history",
    "load_log_latest",
    "log_errors",
    "prune",
    "read_latest",
    "read_snapshots",
    "restore",
    "retain",
    "shrunken",
    "snapshot",
    "snapshot_times",
    "split_attribute_prefix",
    "stale",
    "treebank_tokens",
    "volumes",
    "word_frequency",
]
