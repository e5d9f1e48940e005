"""Operators for preparing language-model training data.

One module per operator; ``registry.py`` holds the registered queries and
their DuckDB oracles.  Nothing outside this subpackage (and
``corpus_pipeline.py``) imports it.
"""
