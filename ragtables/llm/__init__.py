"""Operators of a training-data pipeline: cleaning, linking, mixing, encoding."""
