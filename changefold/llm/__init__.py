"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the package imports this one. Every operator reads whole texts and all
rows, takes the columns it needs by name and leaves other columns alone.
"""
