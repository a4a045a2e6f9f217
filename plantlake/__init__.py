"""Sensor lakehouse analytics written as plain PySpark DataFrame programs."""
