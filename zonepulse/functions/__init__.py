"""Column expressions; all stay JVM-side."""
