"""Column functions: text, aggregates and registered functions."""
