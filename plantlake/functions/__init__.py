"""Scalar and aggregate column helpers; all of them stay JVM-side."""
