"""Data-shaping transforms and domain computations."""
