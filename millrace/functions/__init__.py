"""Column functions: every one returns a JVM-side Column expression."""
