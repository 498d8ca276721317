"""Models built from operators, their registry, and the queries over the driver tables."""
