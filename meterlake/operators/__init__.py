"""Bucketed queries, rollups and lifecycle operators on readings DataFrames."""
