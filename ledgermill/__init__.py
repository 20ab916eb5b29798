"""Ledger analytics on Spark: versioned finance marts from general-ledger extracts.

Every operator is a function from DataFrames to a DataFrame. Rules (measures,
tags, statement lines) are plain data, so a user brings their own chart of
accounts; :mod:`ledgermill.chart` holds the standard one.
"""
