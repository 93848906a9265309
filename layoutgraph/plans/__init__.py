"""Session set-up, lineage cuts and the query catalogue."""
