"""Structured Streaming ingest of landed day files."""

from kiln.streaming.ingest import read_ingested, read_ledger, read_quarantined, read_stream_audit, stream_ingest

__all__ = ["read_ingested", "read_ledger", "read_quarantined", "read_stream_audit", "stream_ingest"]
