"""Operators of a training-data pipeline over documents, pages and vectors.

Nothing else in the library imports this subpackage; ``queries`` registers one
query per operator and the corpus pipeline composes five of them.
"""
