"""Operators for preparing training text: fingerprints, dedup, tokenizing, packing, scoring, archives."""
