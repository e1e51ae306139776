"""Scoring and ranking of assets by place, as PySpark DataFrame operations."""
