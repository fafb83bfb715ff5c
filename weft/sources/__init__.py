"""Readers, writers, catalog tables and scratch storage."""
