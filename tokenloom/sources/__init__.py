"""Readers and writers for story shards, token tables and vocabularies."""
