"""Readers, sinks, declared schemas and the dataset catalogue."""
