"""Ledger operators: every function takes and returns DataFrames and builds a lazy plan."""
