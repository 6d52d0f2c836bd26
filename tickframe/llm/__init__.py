"""Operators for preparing large text corpora (de-duplication, filtering, mixing, packing, search)."""
