"""Readers and source adapters."""
