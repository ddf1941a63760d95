"""Column expressions: message headers, log positions, table names, type casts."""
