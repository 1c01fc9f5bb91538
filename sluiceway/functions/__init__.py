"""Column functions: conforming, measures, flags. All are built-in Spark expressions."""
