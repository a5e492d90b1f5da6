"""Exports, stored tables and run history as DataFrames."""
