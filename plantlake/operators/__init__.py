"""DataFrame → DataFrame transforms of the lakehouse layers."""
