"""Operators of a training-data pipeline, each over whole tables.

One module per operator; ``queries.py`` registers them.  Nothing else in
the library imports this package.
"""
