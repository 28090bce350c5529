"""Operators for preparing training data.

The operators, the queries that apply them and the SQL of those queries live
here; nothing else in the library imports this subpackage.
"""
