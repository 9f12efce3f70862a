"""Readers and writers: page tables, text corpora, term files, the saved index, CSV metrics."""
