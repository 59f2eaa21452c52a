"""Arrival folders as file streams."""
