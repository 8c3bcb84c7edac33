"""Readers, writers and bulk transfer."""
