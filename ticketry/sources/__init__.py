"""Readers, the layered table store and the stand-in tables."""
