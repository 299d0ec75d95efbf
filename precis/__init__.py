"""Dialogue summarisation, validation and evaluation as Spark jobs."""
