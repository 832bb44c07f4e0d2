"""Operators of a training-data pipeline; nothing else in the library imports them.

Each operator takes and returns DataFrames and has its own module.  The thin
registered queries are in ``queries``, their SQL in ``oracle``.
"""
