"""Operators for preparing language-model training data, one module each.

Nothing outside this package imports it.  ``queries`` holds the registered
queries (``QUERIES``) and their DuckDB SQL (``SQL``).
"""
