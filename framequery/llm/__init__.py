"""Operators of a training-data pipeline: filtering, dedup, mixing, tokens, search.

Nothing outside this subpackage imports it.
"""
