"""Structured Streaming jobs: scheduled rollup refresh and watermarked rollups."""
