"""Operators for training-data corpora, and the queries that apply them.

Nothing outside this folder (but the registration in ``__spark_entry__`` and
``corpus_pipeline``) imports it.
"""
