"""Readers, dataset registry, reshaping and sinks."""
