"""Operators over the stored tables.  Each takes and returns DataFrames."""
