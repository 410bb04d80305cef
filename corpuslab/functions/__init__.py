"""Column-level building blocks; all are JVM-side Column expressions."""
