"""Column expressions and row filters shared by the queries."""
