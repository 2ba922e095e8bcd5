"""Operators for preparing large training corpora (see README, section llm)."""
