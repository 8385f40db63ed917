"""Registered queries and the SQL that states their results."""
