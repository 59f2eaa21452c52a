"""Readers of raw public files into the stored tables' shapes."""
