"""Retail analytics on Spark: layered ingestion, profiling, sales, demand and recommendations."""
