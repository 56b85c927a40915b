"""Queries over the given tables and the SQL that has to give the same rows."""
