"""Structured Streaming form of the incremental loads."""
