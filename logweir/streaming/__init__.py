from logweir.streaming.batches import (
    append_files,
    batch_counts,
    batch_results,
    last_batch,
    once_per_batch,
    per_batch_sql,
    run_available,
    stop_when_idle,
    write_batches,
)
from logweir.streaming.counts import (
    chained_windows,
    changed_counts,
    offset_ranges,
    running_counts,
    seeded_counts,
    sliding_counts,
    stateful,
)
from logweir.streaming.idle import idle_totals, open_totals, rocksdb
from logweir.streaming.metrics import BatchCounts, batch_metrics, observed_stream

__all__ = [
    "BatchCounts",
    "append_files",
    "batch_counts",
    "batch_metrics",
    "batch_results",
    "chained_windows",
    "changed_counts",
    "idle_totals",
    "last_batch",
    "observed_stream",
    "offset_ranges",
    "once_per_batch",
    "open_totals",
    "per_batch_sql",
    "rocksdb",
    "run_available",
    "running_counts",
    "seeded_counts",
    "sliding_counts",
    "stateful",
    "stop_when_idle",
    "write_batches",
]
