"""Spark-first analytics engine for advertising facts, cohorts and their checks."""
