"""Column to Column helpers; all of them stay inside JVM expressions."""
