"""Operators for preparing large text corpora: filters, near-duplicates, scoring, packing, token files."""
