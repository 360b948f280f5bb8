"""Scans (raw CSV, crawl JSON, driver tables, catalog tables) and sinks."""
