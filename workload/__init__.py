"""The registered queries: Spark callables over the given tables, with their DuckDB counterparts."""
