"""Operators for building training corpora; nothing outside this folder imports them.

Each module holds one operator with its own interface; ``queries`` registers one query per
operator over the given tables.
"""
