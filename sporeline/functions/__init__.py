"""Column functions on sequences, qualities and names."""
