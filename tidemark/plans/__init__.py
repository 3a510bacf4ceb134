from tidemark.plans.custom import CustomChanges, custom_changes, run_custom_fields, sync_custom_fields, upsert_values
from tidemark.plans.replay import pending, replay
from tidemark.plans.sync import Synced, SyncRun, log_updates, run_feed, sync, sync_report, watermarks
from tidemark.plans.together import FeedSource, sync_all

__all__ = [
    "CustomChanges",
    "FeedSource",
    "SyncRun",
    "Synced",
    "custom_changes",
    "log_updates",
    "pending",
    "replay",
    "run_custom_fields",
    "run_feed",
    "sync",
    "sync_all",
    "sync_custom_fields",
    "sync_report",
    "upsert_values",
    "watermarks",
]
