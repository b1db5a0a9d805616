"""Operators of a training-data pipeline over text; nothing else in the library imports them."""
