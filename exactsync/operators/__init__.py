"""Batch cutting, upserts, load accounting and verification."""
