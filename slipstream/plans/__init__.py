"""Batch plans composed from the operators."""
