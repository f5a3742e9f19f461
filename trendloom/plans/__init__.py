"""Reports composed from the operators."""
