"""Retail analytics warehouse as Spark jobs: ingest, star schema, data checks, dashboards."""
