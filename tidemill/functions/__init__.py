"""Column functions. Everything here is a native Spark expression; there is no Python UDF."""
