"""Operators of a large training-data pipeline, each by one fixed method."""
