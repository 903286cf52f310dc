"""Operators for preparing large text corpora.

Nothing outside this folder imports it.  Every operator is one module with a
general function on DataFrames; ``queries.py`` holds the thin ``opN_<name>``
queries and their SQL.
"""
