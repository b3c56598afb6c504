"""Catalog tables in; ordered text documents, JSONL records and reports out, as Spark jobs."""

from vitrine.sources.catalog import Catalog

__all__ = ["Catalog"]
