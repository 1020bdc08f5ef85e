"""Fixtures over the driver tables and the registry of checked queries."""
