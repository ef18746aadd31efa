"""Column expressions and generic statistics."""
