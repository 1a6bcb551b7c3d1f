"""Corpus operators for training-data pipelines.

Nothing else in the library imports this subpackage. Each module holds one
operator; ``queries.py`` registers one query per operator and its SQL.
"""
