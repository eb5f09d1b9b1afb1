"""Readers for exports and writers for tables."""
