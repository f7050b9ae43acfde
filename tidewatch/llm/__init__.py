"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage, so it can be removed as a
whole.  Every operator takes and returns DataFrames; the contract queries that
run them over whole tables are in :mod:`tidewatch.llm.entry`.
"""
