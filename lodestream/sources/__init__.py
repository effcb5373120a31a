"""Readers and writers for corpora, query sets, vectors, events and logs."""
