"""Report output."""

from quayside.sinks.csv import plain_text, snapshot_folder, stage_snapshot, write_snapshot

__all__ = ["plain_text", "snapshot_folder", "stage_snapshot", "write_snapshot"]
