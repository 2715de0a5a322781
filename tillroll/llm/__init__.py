"""Operators for preparing language-model training data, each also a registered query."""
