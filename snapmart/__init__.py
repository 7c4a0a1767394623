"""Snapshot-mart analytics on Spark: layered panels, labels, features, models, monitoring."""
