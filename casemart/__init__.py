"""casemart: a PySpark library that turns messy public case reports into a
validated star schema with map-ready views.

Layout
------
functions/  Column-level building blocks (cleaning, normalization profiles,
            calendar labels, bounding boxes, scores, status cascades).
operators/  DataFrame -> DataFrame operators (reshape, dimensions, facts,
            record linkage, rule overlays, geocoding candidates, spatial
            dimension and views, data-quality audits).
sources/    table resolution, schema fitting, sinks and load reconciliation.
plans/      compositions: the reference pipeline and the driver queries.
streaming/  incremental ingest of raw line lists with Structured Streaming.
"""

__version__ = "0.1.0"
