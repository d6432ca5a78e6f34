"""Column-level helpers built on native Spark SQL functions."""
