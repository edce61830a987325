"""Column functions and fixed dimensions."""
