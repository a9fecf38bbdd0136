"""Venue and review analytics as Spark DataFrame jobs."""
