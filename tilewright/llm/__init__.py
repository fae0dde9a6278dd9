"""Operators for preparing training text at scale: ten operators and their queries.

Nothing else in the library imports this subpackage.
"""
