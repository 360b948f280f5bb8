"""cinegraph: movie-catalog and recommendation analytics expressed as Spark jobs.

Layout:
    sources/    scans, fixtures over the driver tables, table publishing (sinks)
    functions/  column-level helpers (list split/join, timestamps, validation, hash split)
    operators/  reusable DataFrame -> DataFrame building blocks (ids, latest, hops, top-k, backfill)
    plans/      the user-facing jobs (catalog, interactions, serving, recall, models)
    streaming/  Structured Streaming rating ingest, latest-state and refresh
"""

__version__ = "0.1.0"
