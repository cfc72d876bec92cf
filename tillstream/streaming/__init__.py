"""Structured Streaming jobs: the three window queries, their sinks, triggers,
checkpoints and progress reporting."""
