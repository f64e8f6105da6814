"""Operators of a training-data pipeline over raw text tables.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries. Each operator module has a general interface (columns,
parameters, models); the queries derive the digests that a check compares."""
