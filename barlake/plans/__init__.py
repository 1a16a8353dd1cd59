"""Bindings of the given tables to engine inputs, and the registered queries."""
