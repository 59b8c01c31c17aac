"""The batch steps driven by Structured Streaming."""
