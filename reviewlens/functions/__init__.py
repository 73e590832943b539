"""Column-level building blocks; all of them stay inside the JVM."""
