"""Composed plans: registered queries, their DuckDB oracles, the stage pipeline."""
