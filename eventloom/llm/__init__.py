"""Operators for training data: duplicates, mixing, packing, scoring, extraction."""
