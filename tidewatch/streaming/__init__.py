from tidewatch.streaming.feeds import counts_so_far, ingested, stream_counts, stream_ingest, window_counts
from tidewatch.streaming.routes import routed, stream_routes

__all__ = [
    "counts_so_far",
    "ingested",
    "routed",
    "stream_counts",
    "stream_ingest",
    "stream_routes",
    "window_counts",
]
