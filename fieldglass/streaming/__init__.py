"""Operators on streams of events."""

from .games import live_replay, use_state_store
from .live import Broker, changed_only, exact_new, new_events, purged, replay, run_incremental

__all__ = ["Broker", "changed_only", "exact_new", "live_replay", "new_events", "purged", "replay", "run_incremental", "use_state_store"]
