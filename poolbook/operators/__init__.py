"""Composite operators built from DataFrame built-ins."""
