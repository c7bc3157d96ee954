"""Operators for preparing training text at cluster scale. Nothing else in the library imports this package."""
