"""Retail invoice-line analytics on Spark: bronze, silver and point-in-time customer snapshots."""
