"""Column expressions over text, numbers and arrays."""
