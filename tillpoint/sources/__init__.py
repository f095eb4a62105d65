"""Readers, writers and the warehouse layout."""
