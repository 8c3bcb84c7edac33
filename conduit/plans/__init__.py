"""Reusable multi-stage plans and the catalogue of runnable queries."""
