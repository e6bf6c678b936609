"""Operators for preparing language-model training data, one module each.

Nothing else in the library imports this subpackage; ``registry`` holds its
queries and ``/corpus_pipeline.py`` chains five of the operators.
"""
