"""Operators for preparing training data: filters, tokenizers, near-duplicate removal, search, packing."""
