"""Cleaning, profiling and loading of tabular data and short texts on Spark."""
