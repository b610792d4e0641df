"""Scalar column expressions (all JVM-side, no Python UDFs)."""
