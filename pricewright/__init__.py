"""Pricing and sales analytics on Spark DataFrames."""
