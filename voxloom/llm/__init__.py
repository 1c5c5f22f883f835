"""Operators that prepare training data for language and speech models.

Nothing else in the library imports this subpackage.
"""
