"""Schemas, readers, writers and the bindings to the driver tables."""
