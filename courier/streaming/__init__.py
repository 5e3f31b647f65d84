"""Structured Streaming versions of the queue cycles."""
