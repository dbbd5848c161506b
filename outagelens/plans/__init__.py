"""Whole runs over the layers, and the registry of checked queries with their oracles."""
