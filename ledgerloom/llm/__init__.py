"""Operators for preparing training text: language, duplicates, leaks, secrets, packing and more."""
