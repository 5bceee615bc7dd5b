"""Column functions: keys, projection, distances, rules."""
