"""Composite jobs: window loads and staged steps."""
