"""Operators for training-data corpora: duplicates, contamination, language, tokens, licences, toxicity, markup."""
