"""Readers, writers and the tables that record what was made from what."""
