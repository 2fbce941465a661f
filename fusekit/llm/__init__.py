"""Operators of a training-data pipeline: language identification, token
counts, chat formatting, near-duplicates, quality rules, line dedup, licence
scans, packing, decontamination and URL filters.  Nothing else in the library
imports this subpackage."""
