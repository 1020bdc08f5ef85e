"""Operators of a training-data pipeline, their registered queries and the SQL these are checked against."""
