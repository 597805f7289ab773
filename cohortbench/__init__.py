"""Cohort benchmarking on Spark: yearly coded counts in, comparable entity-year marts out."""
