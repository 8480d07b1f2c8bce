"""Cohort extraction from intensive-care records on Spark DataFrames."""
