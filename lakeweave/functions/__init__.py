"""Column-expression builders (all JVM-side Catalyst expressions)."""
