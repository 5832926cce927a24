"""Readers: document listings, page tables, chunk JSON, record CSV, tables."""
