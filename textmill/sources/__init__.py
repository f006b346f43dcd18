"""Readers: document collections, ranked vocabularies, frequency tables."""
