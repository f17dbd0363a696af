"""Operators for training-data corpora: tokenizing, dedup, search, classifying, packing, formatting.

Nothing else in the package imports this folder.
"""
