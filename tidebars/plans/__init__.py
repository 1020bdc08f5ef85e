"""Batch jobs and read views composed from the operators."""
