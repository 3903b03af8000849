"""Whole jobs made of operators: normalising, windows, reports, reviews."""
