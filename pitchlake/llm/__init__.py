"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage.  Every module exposes a
general operator; ``queries`` derives the registered ``opN_<name>`` digests.
"""
