"""Readers, parsers of raw payload tables, and writers."""
