"""Column builders. Every one is a native Spark expression; there are no UDFs."""
