"""Operators for preparing training text: tokens, duplicates, rules, mixing.

Nothing outside this package imports it; its queries are in ``registry``.
"""
