"""Audit ledger of runs and batches as DataFrames."""
