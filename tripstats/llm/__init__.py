"""Operators of a training-data pipeline: mixing, deduplication, sanitising, quality,
language, packing, token files and chat formatting. Nothing else imports this package."""
