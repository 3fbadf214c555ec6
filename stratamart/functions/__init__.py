"""Column expressions: Column in, Column out."""
