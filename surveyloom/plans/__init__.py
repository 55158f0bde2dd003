"""Whole reports, put together from sources and operators."""
