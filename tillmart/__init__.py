"""Retail lakehouse analytics as ordinary Spark jobs."""
