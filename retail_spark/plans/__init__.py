"""Registered plans over the driver tables: adapters to the canonical Silver
shapes, the Spark queries and their DuckDB oracle SQL."""
