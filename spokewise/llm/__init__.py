"""Operators for large training-data pipelines (ten operators and their registered queries).

Nothing else in the library imports this subpackage. Each operator module
has its own general interface; ``queries`` derives the thin registered
queries from them.
"""
