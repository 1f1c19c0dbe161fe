"""Quillmill: a PySpark-native engine for curating translation and instruction-tuning corpora."""
