"""Committed writes to file datasets and JDBC tables."""
