"""Operators over DataFrames: profiling, encoding, models, tuning, ledger."""
