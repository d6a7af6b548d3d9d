"""Operators for training-data pipelines: deduplication, language, licences, tokens, mixing, archives.

Nothing else in the library imports this package.
"""
