"""Column-level functions, all JVM-side."""
