"""Readers: Bronze trees, layers, JDBC tables and the sensor topic."""
