"""Operators for preparing text corpora to train language models on.

Nothing outside this subpackage imports it, except the query registry.
"""
