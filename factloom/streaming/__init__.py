"""Streams of arriving filings; beyond what batch plans need."""
