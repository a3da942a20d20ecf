"""Operators of a training-data pipeline over ``documents``; nothing outside imports this package."""
