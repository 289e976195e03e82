"""Readers, sinks and the mapping of the driver's tables onto clause tables."""
