"""Operators of a training-data pipeline. Queries in ``queries.py``."""
