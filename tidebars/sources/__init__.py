"""Landed vendor files and the snapshot tables."""
