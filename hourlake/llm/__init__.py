"""Operators for preparing text at training-data scale; nothing else in the library imports this."""
