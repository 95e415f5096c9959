"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Each module holds one operator with its general interface;
``registry`` holds the thin queries and their SQL.
"""
