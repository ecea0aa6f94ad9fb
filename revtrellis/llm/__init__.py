"""Operators for preparing training text: deduplication, tokenisation, decontamination, scoring."""
