"""Column builders. Everything here stays inside Spark's generated code; there are no Python UDFs."""
