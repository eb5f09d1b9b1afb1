"""Pipelines and reports built from the operators."""
