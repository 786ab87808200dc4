"""Registered query plans (Spark) and their DuckDB oracle SQL."""
