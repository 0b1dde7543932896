"""Domain computations over plain tables."""
