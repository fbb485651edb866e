"""Incremental (Structured Streaming) form of the roll-up."""
