"""Operators for large training corpora: dedup, joins, packing, mixing, scoring, archives.

Nothing else in the library imports this package. Every operator takes and
returns DataFrames; ``queries`` holds the registered ``opN_`` queries.
"""
