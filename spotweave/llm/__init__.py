"""Operators for text corpora of language-model training."""
