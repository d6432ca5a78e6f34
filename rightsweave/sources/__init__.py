"""Readers, writers, schema registry and the demo world."""
