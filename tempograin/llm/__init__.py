"""Operators for preparing large training corpora.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; the queries of ``queries.py`` reduce them to digest rows.
"""
