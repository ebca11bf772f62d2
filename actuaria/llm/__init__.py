"""Operators of a training-data pipeline over ``documents`` and ``embeddings``.

Nothing outside this package imports it.  Every operator is a function on
DataFrames with its own general interface; ``queries.py`` registers one thin
query per operator.
"""
