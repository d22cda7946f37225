"""Composed plans: the query catalog and its DuckDB oracles."""
