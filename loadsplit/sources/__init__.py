"""Readers, sinks and the views derived from the driver's test tables."""
