"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this package. Columns are named by parameters;
operators keep every other column of their input unless they say otherwise.
"""
