"""Change tables: every version kept, any version readable."""
