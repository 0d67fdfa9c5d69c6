"""Structured Streaming ingestion of landed responses."""

from .landing import landed_stream, selection_stream, start_reject_ingest, start_selection_ingest

__all__ = ["landed_stream", "selection_stream", "start_reject_ingest", "start_selection_ingest"]
