"""Operators for preparing language-model training corpora.

Nothing else in the library imports this subpackage; it stands on PySpark,
numpy and pyarrow alone and can be removed without touching the rest.
"""
