"""Operators for preparing training text at scale.

Nothing outside this subpackage imports it.  Each operator is a function of
DataFrames; :mod:`arborlit.llm.queries` holds the registered queries.
"""
