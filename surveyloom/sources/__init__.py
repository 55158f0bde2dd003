"""Landed JSON and tables as DataFrames."""
