"""Incremental pickup of new snapshots."""
