"""Incremental runs of the stateless checks (an addition; the batch operators are the same)."""
