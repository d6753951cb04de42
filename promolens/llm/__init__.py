"""Operators for preparing large text corpora for training.

Nothing else in the library imports this subpackage.  Each operator takes a
DataFrame of documents (any extra columns are ignored) and returns one row per
document or piece; ``queries.py`` holds the thin registered queries.
"""
