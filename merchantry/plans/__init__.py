"""Operators composed into the warehouse layers and the report catalogue."""
