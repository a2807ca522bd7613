"""Data-quality, KPI and reconciliation library for Spark DataFrames."""
