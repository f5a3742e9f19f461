"""DataFrame operators: each takes frames of the declared schemas and returns a frame."""
