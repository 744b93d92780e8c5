"""The refresh as Structured Streaming jobs."""
