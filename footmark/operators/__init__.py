"""Relational operators: spatial joins, correspondence, merge, county lookup."""
