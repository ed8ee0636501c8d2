"""Interval analytics over read overlaps, as Spark DataFrame operators."""
