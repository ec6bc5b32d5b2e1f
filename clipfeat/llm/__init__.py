"""Operators of a pipeline for language-model training data."""
