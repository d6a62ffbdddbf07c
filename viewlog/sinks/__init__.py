"""Sinks: catalog tables (create, append, evolve, overwrite, upsert) and JDBC."""
