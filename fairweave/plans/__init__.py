"""Compositions of operators, and the queries over the given tables."""
