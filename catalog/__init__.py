"""Registered queries over the given tables, and the SQL they are checked with."""
