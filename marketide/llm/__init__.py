"""Operators of a training-data pipeline over documents and embeddings.

Nothing else in the library imports this package; it takes general helpers from the
rest (``session``). The registered queries and their SQL are in ``queries``.
"""
