"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  ``queries`` holds the
registered check queries and their DuckDB SQL.
"""
