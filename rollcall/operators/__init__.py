from rollcall.operators.audience import (
    accepted_prefix, exclude_protected, extraction_estimate, mark_welcomed, no_interaction,
    open_periods, posts_since, render_outbox, table_counts, unwelcomed_count, welcome_candidates,
)
from rollcall.operators.history import (
    apply_snapshot, apply_snapshot_split, clean_snapshot, dedupe_snapshot, present_in,
    replay_history, snapshot_calendar,
)
from rollcall.operators.preview import preview
from rollcall.operators.upsert import insert_ignore, pick_row, replace_table, upsert_replace

__all__ = [
    "accepted_prefix", "exclude_protected", "extraction_estimate", "mark_welcomed",
    "no_interaction", "open_periods", "posts_since", "render_outbox", "table_counts",
    "unwelcomed_count", "welcome_candidates", "apply_snapshot", "apply_snapshot_split",
    "clean_snapshot", "dedupe_snapshot", "present_in", "replay_history", "snapshot_calendar",
    "preview", "insert_ignore", "pick_row", "replace_table", "upsert_replace",
]
