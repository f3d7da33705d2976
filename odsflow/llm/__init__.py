"""Operators of a training-data pipeline: near and substring duplicates, quality, decontamination, mixing, tokens."""
