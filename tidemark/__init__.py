"""Filings analytics and equity screening on Spark."""
