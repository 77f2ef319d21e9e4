"""Batch retail analytics on Spark DataFrames: orders, order items and reviews."""
