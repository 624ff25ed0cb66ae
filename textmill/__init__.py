"""Corpus building and curation as Spark DataFrame jobs."""
