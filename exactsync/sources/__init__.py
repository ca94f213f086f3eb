"""Reading tables, queries and JDBC sources."""
