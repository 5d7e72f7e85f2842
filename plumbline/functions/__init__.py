"""Column expressions and the SQL function library."""
