"""Structured Streaming: rating ingest (ST1), latest-rating state (ST2) and the
refresh of touched users' recall lists (ST3)."""
