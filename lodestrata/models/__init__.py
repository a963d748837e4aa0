"""Pluggable models and their offline defaults."""
