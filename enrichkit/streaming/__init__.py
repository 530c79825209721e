"""Structured Streaming entry points."""

from .documents import enrich_stream, read_document_stream, start_enrichment

__all__ = ["enrich_stream", "read_document_stream", "start_enrichment"]
