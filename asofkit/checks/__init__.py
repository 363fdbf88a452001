"""Queries over the given tables, and the same in SQL, to check the operators."""
