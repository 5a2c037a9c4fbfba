"""Readers, derived input tables and sinks."""
