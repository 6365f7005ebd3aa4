"""Operators of a training-data pipeline: cleaning, scoring, de-duplication, mixing, search."""
