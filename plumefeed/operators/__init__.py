"""The jobs: ingest, clean, index, profile, feed, monitoring."""
