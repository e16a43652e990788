"""Readers, writers and the resource schemas they use."""
