"""The registered queries: stand-in inputs on the given tables, Spark queries and comparison SQL."""
