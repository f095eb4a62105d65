"""Operators for building training data from large text and vector tables."""
