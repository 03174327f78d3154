"""Warehouse, business questions, event rollups, data quality, governance."""
