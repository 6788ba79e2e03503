"""Operators for preparing language-model training text.

Every operator is a function of DataFrames with a general interface; the thin
``opN_*`` queries in ``queries.py`` derive the contract's columns from them.
Nothing outside this folder imports it.
"""
