"""The operators as queries over the test tables, each with an SQL statement of
the same result."""
