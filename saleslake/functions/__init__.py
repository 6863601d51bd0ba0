"""Column expressions; each one stays inside the JVM."""
