"""Corpus scans, example files, vector index tables and the guards around them."""
