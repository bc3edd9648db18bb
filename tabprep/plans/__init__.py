"""Compositions of operators, and the registered queries over the given tables."""
