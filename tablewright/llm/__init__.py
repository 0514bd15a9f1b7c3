"""Operators of a training-data pipeline over a ``documents`` table.

One module per operator; ``queries`` binds each to the given tables. Nothing outside this folder imports it.
"""
