"""Operators for building training corpora.

Nothing else in the library imports this subpackage. Each module is one
operator with a general interface; ``queries`` registers one query per
operator over the given tables.
"""
