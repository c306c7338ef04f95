"""Column helpers, global statistics and ordering primitives."""
