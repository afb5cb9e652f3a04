"""Operators that turn a raw document corpus into training data, as Spark jobs."""
