from tidemark.streaming.apply import (
    PushSink,
    apply_pushed,
    read_bodies,
    start_push_stream,
    start_upsert_stream,
)
from tidemark.streaming.feeds import apply_landed, start_feed_stream

__all__ = [
    "PushSink",
    "apply_landed",
    "apply_pushed",
    "read_bodies",
    "start_feed_stream",
    "start_push_stream",
    "start_upsert_stream",
]
