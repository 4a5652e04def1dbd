"""Readers, writers and the hand-off tables between stages."""
