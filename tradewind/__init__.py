"""Layered retail analytics as Spark DataFrame jobs."""
