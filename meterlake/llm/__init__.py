"""Operators of a training-data pipeline over document tables.

Nothing else in the library imports this subpackage.  Every operator takes
DataFrames and column names, keeps rows whole, and is registered as one query
``opN_<name>`` in ``registry``.
"""
