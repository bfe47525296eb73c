"""Column expressions: they take columns and return columns, all JVM-side."""
