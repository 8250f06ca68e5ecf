"""Readers, gates and sinks."""
