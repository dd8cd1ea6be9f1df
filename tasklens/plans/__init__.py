"""Models and queries composed of operators."""
