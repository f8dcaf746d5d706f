"""Rental-analytics lakehouse jobs for PySpark.

Every operator takes DataFrames and gives DataFrames, is built from Spark's own
expressions, and leaves the physical plan to Catalyst and adaptive execution.
"""
