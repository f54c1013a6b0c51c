"""Training-data operators: scoring, tokenisation, quality, dedup and filtering of texts."""
