"""Structured Streaming jobs (AvailableNow runs with checkpoints under spark.checkpoint.dir)."""
