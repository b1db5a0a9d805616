"""Readers, writers, and stamping of landed files."""
