"""Composite flows built from the operators, and the registered query catalog."""
