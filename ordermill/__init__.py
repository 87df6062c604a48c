"""Retail order cleaning, data quality checks and order analytics as Spark DataFrame jobs."""
