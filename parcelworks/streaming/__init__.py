"""The stages as incremental Structured Streaming jobs."""
