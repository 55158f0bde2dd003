"""Operators over training text, and the corpus pipeline's parts."""
