"""Column builders. Everything here stays in JVM code generation; no Python UDFs."""
