"""Operators of a large-scale training-data pipeline (language ID, near-duplicates, extraction,
packing, scoring, cleaning, encoding, PII). Nothing else in the library imports this subpackage."""
