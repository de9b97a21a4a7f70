"""Surveillance-coverage jobs on Spark: functions from DataFrames and thresholds to DataFrames."""
