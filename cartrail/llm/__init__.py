"""Operators for preparing training data; nothing outside this package and ``corpus_pipeline.py`` uses them."""
