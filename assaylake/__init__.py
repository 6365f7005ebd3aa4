"""Candidate scoring and active-learning analytics, written for Spark."""
