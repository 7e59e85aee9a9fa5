"""Cartulary: Spark operators for semi-structured reference data.

Documents are held as VARIANT, normalised and checked with built-in column
expressions, conformed to nested typed tables, and published or joined from there.
"""

__version__ = "0.1.0"
