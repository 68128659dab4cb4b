"""Ways in: delimited text, catalog tables, JDBC."""
