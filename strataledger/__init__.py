"""Warehouse history, temporal lookup, upsert and reconciliation operators on Spark DataFrames."""
