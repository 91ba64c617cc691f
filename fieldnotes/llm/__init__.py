"""Operators for preparing training text at scale.

Nothing outside this subpackage imports it. Each operator has its own
module with a general interface; ``queries.py`` registers the thin queries.
"""
