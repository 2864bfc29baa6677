"""Whole jobs: ingest, daily summary, backfill."""
