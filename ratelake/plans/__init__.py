"""Composed jobs: daily and backfill runs, and the query catalogue."""
