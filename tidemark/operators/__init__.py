"""Operators on event, window, document and prediction tables."""
