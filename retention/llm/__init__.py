"""Operators of a training-data pipeline (see ``queries`` for what is registered).

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
