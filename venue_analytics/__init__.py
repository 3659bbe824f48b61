"""Venue and event analytics as Spark jobs: DataFrames in, DataFrames out."""
