"""Ways out: JSON lines, delimited text, JDBC."""
