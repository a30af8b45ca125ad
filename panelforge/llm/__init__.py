"""Operators for preparing training corpora, their queries and their SQL.

Nothing else in the library imports this package.
"""
