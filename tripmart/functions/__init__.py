"""Scalar column functions, all built from JVM-side expressions."""
