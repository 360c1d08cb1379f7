"""Warehouse path: star schema (M), direct file queries (X) and dashboards (K)."""
