"""Hourly-measurement analytics on Spark: bronze, silver, gold, star, mart."""
