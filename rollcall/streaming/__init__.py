from rollcall.streaming.snapshots import apply_files, read_history, snapshot_stream

__all__ = ["apply_files", "read_history", "snapshot_stream"]
