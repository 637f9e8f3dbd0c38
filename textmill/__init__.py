"""Corpus preparation as Spark jobs."""
