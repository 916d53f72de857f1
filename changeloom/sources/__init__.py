"""Change logs, source snapshots and written tables."""
