"""Operators of a training-data pipeline: duplicates, fingerprints, tokens, toxicity, mixing, URLs, tool calls."""
