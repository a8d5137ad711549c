"""Composed plans: stage graph, registered queries, DuckDB oracle."""
