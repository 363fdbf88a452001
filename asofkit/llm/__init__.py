"""Operators of a training-data pipeline over documents, pages and labels. Nothing else in the library imports this."""
