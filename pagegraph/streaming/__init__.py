"""The incremental forms on Structured Streaming."""
