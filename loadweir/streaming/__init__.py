from loadweir.streaming.streams import (
    interval_metrics,
    stream_append,
    stream_dedup,
    stream_interval_metrics,
    stream_merge,
    stream_quarantine,
)

__all__ = [
    "interval_metrics",
    "stream_append",
    "stream_dedup",
    "stream_interval_metrics",
    "stream_merge",
    "stream_quarantine",
]
