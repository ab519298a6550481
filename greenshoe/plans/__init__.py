"""The jobs: staging, mart, extraction, enrichment, ingest, quality and reports."""
