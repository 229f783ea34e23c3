"""Streaming runs and sinks."""
