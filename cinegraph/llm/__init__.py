"""Training-data operators for a large text corpus (mixing, scans, near-duplicates, token counts, ...)."""
