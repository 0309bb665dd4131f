"""Column expressions. All of them run inside the JVM; there are no user-defined functions."""
