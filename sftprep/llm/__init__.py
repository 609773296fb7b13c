"""Operators for building training corpora, their queries and their SQL.

Nothing outside this folder and ``corpus_pipeline.py`` imports it.
"""
