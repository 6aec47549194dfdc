"""Readers, writers and the account views derived from the order tables."""
