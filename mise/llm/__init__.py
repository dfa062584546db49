"""Operators of a training-data pipeline over the tables ``documents``, ``labels`` and ``benchmark``.

One module per operator; :mod:`mise.llm.queries` binds each to its whole table and holds the DuckDB
SQL.  Nothing outside this package imports it.
"""
