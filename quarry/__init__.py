"""Spark-first engine for planning, labelling, deduplicating and validating large datasets."""
