"""Tickloom: market-data analytics and training-data preparation on Spark."""
