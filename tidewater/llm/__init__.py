"""Operators for preparing training text at scale.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface, the registered query over the given tables, and its
DuckDB SQL where SQL can express the result.
"""
