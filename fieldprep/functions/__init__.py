"""Column expressions. Everything here is a pure JVM-side Spark expression."""
