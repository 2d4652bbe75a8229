"""Whole jobs composed from the operators, and the queries that exercise them."""
