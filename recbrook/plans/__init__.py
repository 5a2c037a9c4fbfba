"""Composed plans: the query registry, its DuckDB oracle, end-to-end jobs."""
