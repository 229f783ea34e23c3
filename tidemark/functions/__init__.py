"""Schemas and column expressions."""
