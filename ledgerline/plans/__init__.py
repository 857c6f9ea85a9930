"""Bound query plans: the catalogue of registered queries, their DuckDB
oracles, and the end-to-end jobs."""
