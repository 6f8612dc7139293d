"""Column functions: text, hazard and geodesy."""
