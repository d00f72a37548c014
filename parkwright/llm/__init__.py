"""Operators of a large-scale training-data pipeline, one module each.

Nothing outside this subpackage imports it. ``queries`` holds the registered
queries and their SQL; every other module is an operator with a general
interface of its own.
"""
