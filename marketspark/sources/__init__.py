"""Readers, writers and scratch space."""
