"""Column → Column functions."""
