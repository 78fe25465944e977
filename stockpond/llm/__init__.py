"""Operators of a training-data pipeline: tokens, near duplicates, search, language, secrets, scores."""
