"""Incremental ingest of incident files (the raw-row cache, kept up to date)."""

from headway.streaming.ingest import ingest_incident_files

__all__ = ["ingest_incident_files"]
