"""Supplier-master analytics on Spark DataFrames."""
