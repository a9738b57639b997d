"""Incremental ingest of arriving source files (Structured Streaming)."""

from .ingest import ingest_declarations

__all__ = ["ingest_declarations"]
