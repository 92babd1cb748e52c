"""Readers, configuration tables and writers."""
