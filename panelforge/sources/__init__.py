"""Readers: tables, bar text files, filings, event logs and catalog files."""
