"""Structured Streaming paths (whole new files, availableNow)."""
