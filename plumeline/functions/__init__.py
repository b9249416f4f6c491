"""Column expressions: keys, text, angles, distances, spectral scalars."""
