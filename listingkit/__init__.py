"""listingkit — build place-listing datasets on Spark.

From a table of administrative boundaries the library repairs area names,
covers an area with a metric point lattice and crosses the points with
keywords into search jobs; from a table of captured result pages it extracts
listing rows, keeps those within each job's radius, reports jobs without
results, merges passes with a deterministic keep-first dedupe and produces a
clean listings table plus an exploded amenities table.

Layout:
  sources/    table readers/writers and driver-table derivations
  functions/  column expressions (text, link fields, geodesy)
  operators/  relational building blocks (dedupe, ids, lattice, jobs, pages)
  plans/      the composite pipelines P1..P7
  streaming/  incremental page ingestion (Structured Streaming)
"""

from listingkit.session import get_spark, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "ensure_checkpoint_dir"]
