"""Readings schema, time-partitioned layouts and file-listing catalogues."""
