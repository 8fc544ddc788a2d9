"""Sinks: append-only Bronze, versioned tables, table bootstrap."""
