"""Structured Streaming forms of the ingest, the bookmarks, the targets and the report."""
