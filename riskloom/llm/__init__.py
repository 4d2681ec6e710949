"""Operators that prepare text corpora for language-model training.

Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""
