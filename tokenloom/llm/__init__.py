"""Operators of a training-data pipeline: scans, near-duplicates, language, toxicity, quality, extraction, mixing, tokens.

Nothing outside this package imports it.
"""
