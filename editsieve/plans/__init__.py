"""Registered queries over the driver's tables, each beside its DuckDB twin."""
