"""Queries over the stand-in tables and the SQL they are checked against."""
