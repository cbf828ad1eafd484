"""Composed queries over whole tables, with the SQL they must agree with."""
