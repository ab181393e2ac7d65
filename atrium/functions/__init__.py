"""Functions of the scene engine."""
