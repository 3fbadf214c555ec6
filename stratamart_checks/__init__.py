"""Queries over the given test tables and the SQL each of them must agree with."""
