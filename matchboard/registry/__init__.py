"""Queries over the order tables, each with the SQL it must agree with."""
