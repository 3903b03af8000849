"""The same jobs fed by streams."""
