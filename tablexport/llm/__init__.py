"""Operators of a training-data pipeline, as Spark jobs over whole tables.

Nothing else in the library imports this subpackage. Every operator takes
DataFrames (or columns) and returns DataFrames; ``queries`` binds them to
the given tables.
"""
