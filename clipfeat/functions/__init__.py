"""Column builders: index arithmetic, vectors, names."""
