"""Column expressions over text and numbers."""
