"""Operators of a training-data pipeline: scoring, deduplication, extraction, mixing and tokenization of documents."""
