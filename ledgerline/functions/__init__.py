"""Column expressions (JVM-side, codegen'd); no Python UDFs."""
