"""Column expressions: every scalar rule of the library is a plain Spark expression."""
