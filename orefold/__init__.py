"""Layered warehouse loads, history tables and sales analytics on Spark DataFrames."""
