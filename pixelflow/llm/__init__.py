"""Operators for training-data pipelines (see the queries in ``queries.py``).

Nothing else in the library imports this subpackage.
"""
