"""Operators that prepare text corpora for model training.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and ``corpus_pipeline.py`` at the repository top chains them.
"""
