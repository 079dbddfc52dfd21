"""A PySpark engine that curates corpora of conversation logs."""
