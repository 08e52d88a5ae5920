"""Reliable order and retail analytics as Spark DataFrame jobs."""
