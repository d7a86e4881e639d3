"""Batch pipelines composed from the operators."""
