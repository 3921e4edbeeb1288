"""Warehouse loading and change capture as pure DataFrame transformations on Spark."""
