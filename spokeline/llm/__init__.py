"""Operators for preparing training text: one module each, with its query at the end."""
