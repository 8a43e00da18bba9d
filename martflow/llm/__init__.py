"""Operators for preparing training data at scale.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
