"""Operators of a training-data pipeline (deduplication, quality, decontamination, scoring,
search, tokenisation, language, personal data). Nothing else in the library imports this
subpackage; it may import the library's general helpers."""
