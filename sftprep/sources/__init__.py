"""Manifest, readers, integrity report, caches and sinks."""
