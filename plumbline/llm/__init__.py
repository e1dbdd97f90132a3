"""Operators of a training-data pipeline over web-scale text, one module per operator.

Nothing else in the library imports this package; `__spark_entry__` adds its queries if it is there.
"""
