"""Column functions: text, time, identity."""
