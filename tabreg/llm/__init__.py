"""Operators for preparing training text at scale.

Nothing else in the library imports this package. Every operator takes and
returns DataFrames; intermediate tables go to the shared checkpoint folder.
"""
