"""Registered queries over the given tables, with the SQL that each must equal."""
